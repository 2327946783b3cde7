"""Token blocks, prefix counts and merge-dropout against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from benchloom.llm import merge_dropout, prefix_counts, token_blocks
from benchloom.llm.queries import QUERIES
from tests.llm.odd import table

WORD, BYTE, PIECE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
FOLDER = "/root/testdata/sf0.001"
PARTS = [
    "a", "B", "the", " ", "  ", "   ", "\n", " \n", "\t", ".", ",", "!", "'re", "'r", "'s", "'", "1", "23", "é", "ß", "İ", "Σ", "\x00",
    "<|endoftext|>", "<|ENDOFTEXT|>", "<|endo", "<0x0A>", "<unk>", "日本", " ", "́", "̸", "=", "😀", "ing", "hello world",
]


def texts(n, seed, parts=PARTS):
    draw = random.Random(seed)
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(n)]


# --- blocks


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("most", [1, 2, 300, 49_000, 2**32 - 1])
def test_blocks_round_trip(n, most):
    draw = random.Random(n + most)
    ids = np.array([draw.randint(0, most if draw.random() < 0.9 else 2**32 - 1) for _ in range(n)], np.uint32)
    data = token_blocks.pack_ids(ids)
    assert (token_blocks.read_ids(data) == ids).all()
    assert (token_blocks.read_ids(data, 10, 1500) == ids[10:1500]).all()


def test_blocks_use_width_and_exceptions():
    ids = np.full(1024, 7, np.uint32)
    ids[:20] = 60_000
    assert len(token_blocks.pack_ids(ids)) < 300  # width 0 and 20 exceptions


def test_word_encoder_equals_library():
    library, own = Tokenizer.from_file(WORD), token_blocks.encoder(WORD)
    sample = texts(1500, 1)
    ids, counts = own.encode(pa.array(sample, pa.large_string()))
    found = np.split(ids, np.cumsum(counts)[:-1])
    assert [x.tolist() for x in found] == [library.encode(x, add_special_tokens=False).ids for x in sample]


def test_op2(spark):
    library, start = Tokenizer.from_file(WORD), 0
    found = {r["doc_id"]: r for r in QUERIES["op2_token_blocks"](spark, FOLDER).collect()}
    rows = sorted(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    for row in rows:
        ids = np.array([*library.encode(row["text"], add_special_tokens=False).ids, 1], "<u4")
        own = found.pop(row["doc_id"])
        assert (own["start"], own["n_tokens"], own["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not found


def test_token_tables_of_odd_rows(spark, tmp_path):
    library = Tokenizer.from_file(WORD)
    token_blocks.write_tokens(table(spark), f"file://{tmp_path}/blocks", WORD, 1)
    found = token_blocks.read_tokens(spark, f"file://{tmp_path}/blocks").orderBy("start").collect()
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in table(spark).collect()))
    assert [r["ids"] for r in found] == [[*library.encode(t, add_special_tokens=False).ids, 1] for _, _, t in rows]
    assert found[0]["doc_id"] is None
    token_blocks.write_tokens(table(spark).limit(0), f"file://{tmp_path}/none", WORD, 1)
    assert token_blocks.read_tokens(spark, f"file://{tmp_path}/none").count() == 0


# --- prefix counts


def test_prefix_counts_equal_library():
    library, own = Tokenizer.from_file(BYTE), prefix_counts.counter(BYTE)
    for text in texts(500, 2):
        want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
        assert own.prefixes(text).tolist() == want, text
        for budget in (0, 3, 8):
            tokens, fit = prefix_counts.count_texts(own, pa.array([text], pa.large_string()), budget)
            assert tokens[0] == (want[-1] if want else 0)
            assert fit[0] == max([i + 1 for i, n in enumerate(want) if n <= budget], default=0)


def test_op10(spark):
    library = Tokenizer.from_file(BYTE)
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in QUERIES["op10_prefix_counts"](spark, FOLDER).collect()}
    for row in rows:
        own, n = found[row["doc_id"]], len(library.encode(row["text"], add_special_tokens=False).ids)
        assert (own["n_tokens"], own["n_bytes"], own["over_limit"]) == (n, len(row["text"].encode()), n > 1024)
        assert (own["fit_chars"] == len(row["text"])) == (n <= 1024)
    assert len(found) == len(rows)


def test_sliced_batches_are_read_right():
    sample = [x * 50 for x in texts(300, 5)]
    whole = pa.record_batch([pa.array(sample)], ["text"])
    library, own = Tokenizer.from_file(BYTE), prefix_counts.counter(BYTE)
    from benchloom.llm.batches import pieces, texts_of

    found = [n for x in pieces([whole], "text", 5000) for n in prefix_counts.count_texts(own, texts_of(x, "text"), 10)[0].tolist()]
    assert found == [len(library.encode(x, add_special_tokens=False).ids) for x in sample]


def test_prefix_tables_of_odd_rows(spark):
    counts = prefix_counts.count_tokens(table(spark), "doc_id", BYTE).collect()
    library = Tokenizer.from_file(BYTE)
    want = sorted(len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in table(spark).collect())
    assert sorted(r["n_tokens"] for r in counts) == want
    profile = prefix_counts.prefix_profile(table(spark), "doc_id", BYTE).withColumn("fit", prefix_counts.fits("prefix_counts", 1024))
    fit = sorted((r["doc_id"] or 0, r["fit_chars"]) for r in counts)
    assert sorted((r["doc_id"] or 0, r["fit"]) for r in profile.collect()) == fit
    assert prefix_counts.count_tokens(table(spark).limit(0), "doc_id", BYTE).count() == 0


# --- merge-dropout

MARKS = [*PARTS, "▁", " ▁"]


def test_without_dropout_as_the_library():
    library, own = SentencePieceProcessor(model_file=PIECE), merge_dropout.vocabulary(PIECE)
    sample = texts(1500, 3)
    ids, counts = own.encode(pa.array(sample, pa.large_string()), 0.0, 1, 0)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library.encode(sample)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_lossless(dropout):
    own, sample = merge_dropout.vocabulary(PIECE), texts(800, 4, MARKS)
    ids, counts = own.encode(pa.array(sample, pa.large_string()), dropout, 7, 1)
    assert [x.decode() for x in own.decode(ids, counts)] == sample


def test_dropout_is_keyed():
    own, sample = merge_dropout.vocabulary(PIECE), pa.array(["the weather was not so good in november"], pa.large_string())
    cut = lambda *a: own.encode(sample, *a)[0].tolist()
    assert cut(0.3, 1, 0) == cut(0.3, 1, 0)
    assert len({tuple(cut(0.3, seed, variant)) for seed in (1, 2) for variant in (0, 1, 2)}) > 3
    assert len(cut(0.0, 1, 0)) < len(cut(0.5, 1, 0)) < len(cut(1.0, 1, 0))


def test_op4(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id", "text as want")
    found = QUERIES["op4_merge_dropout"](spark, FOLDER)
    assert found.where("lossless").count() == rows.count() == found.count()
    assert merge_dropout.decode(found, PIECE).join(rows, "doc_id").where("text = want").count() == rows.count()


def test_dropout_tables_of_odd_rows(spark):
    found = merge_dropout.encode(table(spark), PIECE)
    assert found.where("lossless").count() == table(spark).count()
    back = sorted((r["doc_id"] or 0, r["text"]) for r in merge_dropout.decode(found, PIECE).collect())
    assert back == sorted((r["doc_id"] or 0, r["text"] or "") for r in table(spark).collect())
    assert merge_dropout.encode(table(spark).limit(0), PIECE).count() == 0


def naive_segment(own, word, dropout, seed, variant):
    """All pairs of neighbours are looked at anew for every merge."""
    symbols, skipped = [c.replace(" ", merge_dropout.MARK) for c in word], set()
    limit, key = int(dropout * 2**64), merge_dropout._word_hash(word, seed, variant)
    while True:
        best, at = None, 0
        for i in range(len(symbols) - 1):
            rank = own.rank.get(symbols[i] + symbols[i + 1])
            if rank is not None and (at, symbols[i], symbols[i + 1]) not in skipped and (best is None or (rank, at) < best[:2]):
                best = rank, at, i
            at += len(symbols[i])
        if best is None:
            return [i for x in symbols for i in ([own.ids[x]] if x in own.ids else [own.bytes[b] for b in x.encode()])]
        _, at, i = best
        merged = symbols[i] + symbols[i + 1]
        if (key ^ (at << 16 | len(merged)) * merge_dropout.SPREAD & merge_dropout.ALL) * merge_dropout.MIX & merge_dropout.ALL < limit:
            skipped.add((at, symbols[i], symbols[i + 1]))
        else:
            symbols[i : i + 2] = [merged]


def test_dropout_equals_naive_merging():
    own = merge_dropout.vocabulary(PIECE)
    words = [" " + w for x in texts(300, 6) for w in x.split(" ") if merge_dropout.MARK not in w and w] + [" é中🙂x", " Übergrößenträger", " aaaaaaaaaaaaaaa", " 1234567890"]
    words = list(dict.fromkeys(words))
    for dropout in (0.1, 0.5):
        found = own.words(words, dropout, 13, 2)
        assert [list(np.frombuffer(x, "<u4")) for x in found] == [naive_segment(own, x, dropout, 13, 2) for x in words]
