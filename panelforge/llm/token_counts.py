"""Token counts of whole texts; huge documents by overlapping chunks that are spliced where both agree.

A document of more than ``chunk_chars`` characters is encoded in chunks with offsets.  A chunk overlaps its predecessor, and
the two are spliced at a position in the overlap that is stable for both: the text has white space before it, which the
tokenizer drops, so no token reaches across it whatever the context; both encodings begin a token there; and both agree on
every token up to the next such position.  Where the overlap has no such position it is widened, at last to the whole rest
of the document, so the result is that of encoding the text at once.  Tokenizers that do not drop white space have no proven
positions and encode documents whole.

Defined results: NULL and empty texts have no tokens; repeated rows are each counted; an empty table gives an empty table;
extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import append_columns
from panelforge.llm.token_encoder import PieceEncoder, encoder

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
LIMIT = 2_048

_WHITE = " \t\n\r\f\v"


def stable_position(text: str, begin: int, end: int, left: tuple[list[int], list[int]], right: tuple[list[int], list[int]]) -> int | None:
    """A position in text[begin:end] where the encodings ``left`` and ``right`` (ids, starts) may be spliced.

    Searched from the middle of the overlap outwards to its end, then from its beginning.
    """
    middle = (begin + end) // 2
    for low, high in ((middle, end), (begin, middle)):
        at = low
        while at < high:
            if at > begin and text[at - 1] in _WHITE and text[at] not in _WHITE:
                stop = at
                while stop < end and text[stop] not in _WHITE:
                    stop += 1
                if stop < end:  # the whole word lies in both chunks
                    i, j = bisect_left(left[1], at), bisect_left(right[1], at)
                    k, m = bisect_left(left[1], stop), bisect_left(right[1], stop)
                    agree = left[0][i:k] == right[0][j:m] and left[1][i:k] == right[1][j:m]
                    if k > i and left[1][i] == at and agree:
                        return at
                at = stop
            at += 1
    return None


def spliced_ids(text: str, tokenizer, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> tuple[list[int], int]:
    """Ids of a whole text from overlapping chunks, and how often an overlap was widened."""

    def encoded(a: int, b: int) -> tuple[list[int], list[int]]:
        found = tokenizer.encode(text[a:b], add_special_tokens=False)
        return found.ids, [a + s for s, _ in found.offsets]

    ids: list[int] = []
    widened = 0
    begin, end = 0, min(len(text), chunk)
    current, start = encoded(begin, end), 0
    while end < len(text):
        width = overlap
        while True:
            next_begin = max(start, end - width)
            next_end = min(len(text), next_begin + max(chunk, 2 * width))
            following = encoded(next_begin, next_end)
            at = stable_position(text, next_begin, end, current, following)
            if at is not None or next_begin <= start:
                break
            width, widened = width * 2, widened + 1
        if at is None:
            # not even the whole chunk has a stable position: encode a longer one from the last proven position
            end = min(len(text), end + (end - start) + chunk)
            current, widened = encoded(start, end), widened + 1
            continue
        i, j = bisect_left(current[1], start), bisect_left(current[1], at)
        ids += current[0][i:j]
        current, start, end = following, at, next_end
    ids += current[0][bisect_left(current[1], start) :]
    return ids, widened


def counted(text: bytes | None, pieces: PieceEncoder, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> tuple[int, int]:
    """Tokens of a whole text, and how often an overlap was widened."""
    if not text:
        return 0, 0
    if len(text) > chunk and pieces.drops_white_space:
        decoded = text.decode("utf-8", "replace")
        if len(decoded) > chunk:
            ids, widened = spliced_ids(decoded, pieces.tokenizer, chunk, overlap)
            return len(ids), widened
    return pieces.count(text), 0


def token_counts(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS
) -> DataFrame:
    """One row per document: bytes, tokens, whether they are over the limit, and overlaps widened on the way."""

    def compute():
        pieces = encoder(tokenizer_path)
        return lambda texts: [list(c) for c in zip(*(counted(t, pieces, chunk_chars, overlap_chars) for t in texts), strict=True)] if texts else [[], []]

    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    done = append_columns(narrow, "text", [("n_tokens", "long"), ("n_widened", "long")], compute)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return done.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_widened")
