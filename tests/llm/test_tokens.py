import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelforge.llm import sequence_files, token_counts
from panelforge.llm.queries import tokenizer_path
from panelforge.llm.token_encoder import PieceEncoder
from tests.llm.frames import awkward_documents, empty_documents

WORD = Tokenizer.from_file(tokenizer_path())
ODD = ["été", "ŒUVRE", "STRASSE", "ß", "ΟΔΟΣ", "éa", "x y", "a b", "\x1c", "\x85", "don't", "it's'll", "<|endoftext|>", "<|end", "12½", "漢字", "\U0001f600", "ﬁ", "İ", "́", "''s", "a'RE", "×÷", "ªº", "\x00"]


def whole(text):
    return WORD.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def pieces():
    return PieceEncoder(tokenizer_path())


def ids(pieces, text):
    return np.frombuffer(pieces.encode(text.encode()), pieces.width).tolist()


@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=8)), max_size=12), st.sampled_from([" ", "\n", "\t", "", "  "]))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(words, between):
    text = between.join(words)
    assert ids(PIECES, text) == whole(text)


PIECES = PieceEncoder(tokenizer_path())


def test_other_tokenizers_encode_the_whole_text():
    other = PieceEncoder(tokenizer_path("byte_bpe_50k.json"))
    text = "Two  spaces and\nlines"
    assert not other.drops_white_space
    assert ids(other, text) == Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("chunk", "overlap"), [(40, 4), (64, 16), (500, 32)])
def test_spliced_chunks_give_the_ids_of_the_whole_text(chunk, overlap):
    r = random.Random(chunk)
    for _ in range(20):
        words = [r.choice([*ODD, "tokenization", "of", "overlapping", "x" * r.randint(1, 90), "éé" * r.randint(1, 30)]) for _ in range(r.randint(1, 120))]
        text = "".join(w + r.choice([" ", " ", "\n", "\t ", " ", ""]) for w in words)
        assert token_counts.spliced_ids(text, WORD, chunk, overlap)[0] == whole(text)


def test_texts_without_white_space_widen_to_the_end():
    text = "ab" * 700
    found, widened = token_counts.spliced_ids(text, WORD, 100, 10)
    assert found == whole(text) and widened > 0


def test_counts_against_the_library(spark):
    docs = awkward_documents(spark)
    for chunk in (50, 16_384):
        found = token_counts.token_counts(docs, tokenizer_path(), chunk_chars=chunk, overlap_chars=8).collect()
        expected = Counter((r["doc_id"], len((r["text"] or "").encode()), len(whole(r["text"])), len(whole(r["text"])) > 2048) for r in docs.collect())
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in found) == expected
    assert token_counts.token_counts(empty_documents(spark), tokenizer_path()).count() == 0


def test_files_round_trip(spark):
    docs = awkward_documents(spark)
    manifest = sequence_files.write_sequences(docs, tokenizer_path(), length=64, batch_sequences=3)
    found = sequence_files.read_sequences(manifest).collect()
    encoded = Counter((r["doc_id"], tuple(whole(r["text"]) + [2])) for r in docs.collect())
    sums = Counter((doc, len(t), crc32(np.array(t, "<u4").tobytes())) for doc, t in encoded.elements())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == sums
    placed = sorted(found, key=lambda r: r["start"])
    assert [r["start"] for r in placed] == [sum(x["n_tokens"] for x in placed[:i]) for i in range(len(placed))]
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in placed]
    assert keys == sorted(keys)


def test_sequences_are_views_of_equal_length_with_masks(spark):
    docs = awkward_documents(spark)
    files = sequence_files.write_sequences(docs, tokenizer_path(), length=64, batch_sequences=3).orderBy("part").collect()
    stream = [t for r in sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)) for t in [*whole(r["text"]), 2]]
    at = 0
    for row in files:
        reader = sequence_files.SequenceFile(row["file"])
        count = -(-row["n_tokens"] // 64)
        assert reader.reader.schema.field("ids").type == pa.list_(pa.uint16(), 64)
        for k in range(count):
            values, mask = reader.sequence(k)
            used = min(64, row["n_tokens"] - 64 * k)
            assert len(values) == 64 and mask.to_pylist() == [True] * used + [False] * (64 - used)
            assert not values.flags.owndata and not values.flags.writeable
            assert values[:used].tolist() == stream[at + 64 * k : at + 64 * k + used] or row["part"] < 0
        at += row["n_tokens"]
    assert at == len(stream)


def test_empty_table_gives_no_files(spark):
    manifest = sequence_files.write_sequences(empty_documents(spark), tokenizer_path())
    assert manifest.count() == 0 and sequence_files.read_sequences(manifest).count() == 0
