"""Token ids of whole texts with the tokenizers library, remembering the pieces between white space.

Tokenizers whose pre-tokenizer drops white space never join text across it, so the ids of a text are those of its pieces in
order, and a piece needs encoding once per worker.  The memo is bounded.  Whether a tokenizer is of this kind is read from
its own description; any other is asked for the whole text every time.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

from tokenizers import Tokenizer, pre_tokenizers

_PIECES, _PARTS = 400_000, 300_000
_ENCODERS: dict[str, PieceEncoder] = {}

#: The description of normalizer and pre-tokenizer for which plain pieces may skip normalisation.
_PLAIN_STEPS = ["NFC", "Replace", "Lowercase"]
_PLAIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _latin_letters() -> str:
    """Lower-case letters of Latin-1 that normalisation leaves as they are."""
    return "".join(c for c in map(chr, range(0xDF, 0x100)) if c.isalpha() and unicodedata.normalize("NFC", c) == c)


class PieceEncoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = "H" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.item_bytes = array(self.width).itemsize
        about = json.loads(self.tokenizer.to_str())
        steps = (about.get("pre_tokenizer") or {}).get("pretokenizers") or [about.get("pre_tokenizer") or {}]
        first = steps[0]
        added = about.get("added_tokens") or []
        #: Is white space dropped, so that the text can be cut there?
        self.drops_white_space = (
            first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) and "\\s" in str(first.get("pattern"))
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) for t in added)
            and about.get("post_processor") is None
        )
        normalizers = (about.get("normalizer") or {}).get("normalizers") or []
        plain = (
            self.drops_white_space and [n["type"] for n in normalizers] == _PLAIN_STEPS and first["pattern"] == {"Regex": _PLAIN_SPLIT}
            and [s["type"] for s in steps[1:]] == ["ByteLevel"] and all(t["content"].startswith("<|") for t in added)
        )
        self._plain = None
        if plain:
            letters = _latin_letters()
            upper = "".join(c.upper() for c in letters if len(c.upper()) == 1 and ord(c.upper()) < 256)
            self._plain = re.compile(f"[!-~{letters}{upper}]+")
            self._parts_of = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{letters}]+|[0-9]|[^a-z0-9{letters}]+").findall
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self._bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
        self._pieces: dict[bytes, bytes] = {}
        self._parts: dict[str, bytes] = {}

    def _pack(self, ids) -> bytes:
        return array(self.width, ids).tobytes()

    def _part(self, part: str) -> bytes:
        known = self._parts.get(part)
        if known is None:
            if len(self._parts) >= _PARTS:
                self._parts.clear()
            mapped = part if part.isascii() else part.translate(self._bytes)
            known = self._parts[part] = self._pack([t.id for t in self.tokenizer.model.tokenize(mapped)])
        return known

    def _encode_piece(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        if self._plain is not None and "<|" not in text and self._plain.fullmatch(text):
            parts = self._parts_of(text.lower())
            return self._part(parts[0]) if len(parts) == 1 else b"".join(map(self._part, parts))
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: bytes | None) -> bytes:
        """Ids of a whole UTF-8 text as unsigned integers of ``item_bytes`` bytes each, in the machine's order."""
        if not text:
            return b""
        if not self.drops_white_space:
            return self._pack(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
        pieces = text.split()  # at ASCII white space only; any other kind stays inside a piece
        known = self._pieces
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            pass
        if len(known) >= _PIECES:
            known.clear()
        for p in pieces:
            if p not in known:
                known[p] = self._encode_piece(p)
        return b"".join([known[p] for p in pieces])

    def count(self, text: bytes | None) -> int:
        return len(self.encode(text)) // self.item_bytes


def encoder(path: str) -> PieceEncoder:
    """The encoder of this worker process for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
