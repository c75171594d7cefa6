"""Shards: the permutation, and what is read back against the tokenizer."""

import zlib

import numpy as np
import public_tokenizers
import pytest

from conftest import DATA
from roadevents.llm import shards as sh
from roadevents.llm.tokens import WORD_BPE, Encoder, encoder


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(total):
    slots = sh.permuted(np.arange(total), total)
    assert sorted(slots) == list(range(total))
    if total > 100:
        assert (slots != sh.permuted(np.arange(total), total, key=1)).mean() > 0.9
        assert abs(np.corrcoef(slots, np.arange(total))[0, 1]) < 0.2
    assert len(sh.permuted(np.arange(0), 0)) == 0


def check(docs, path, stride, records):
    rows = docs.select("doc_id", "text").collect()
    found = sh.materialise_documents(docs, path, stride=stride, records=records)
    manifest = found.manifest.collect()
    assert sorted(r["slot"] for r in manifest) == list(range(found.total))
    assert sorted(r["sequence"] for r in manifest) == list(range(found.total))
    table = found.read(0, found.total)
    stream, begins = [], []
    for r in sorted(manifest, key=lambda r: r["sequence"]):
        record = table[r["slot"]]
        assert zlib.crc32(record.tobytes()) == r["record_crc32"]
        assert r["shard"] == r["slot"] // records
        assert r["byte_offset"] == r["slot"] % records * stride * 2
        assert (record[r["n_tokens"] :] == sh.PAD).all()
        begins.append((len(stream), r["doc_id"], r["start"]))
        stream += record[: r["n_tokens"]].tolist()
    expected, at = [], {}
    for r, own in zip(rows, encoder().ids([r["text"] or "" for r in rows])):
        for i in range(len(own) + 1):
            at[len(expected) + i] = (r["doc_id"], i)
        expected += [*own.tolist(), sh.END_ID]
    assert stream == expected
    assert all(at[place] == (doc, start) for place, doc, start in begins)
    short = sum(r["n_tokens"] < stride for r in manifest)
    assert short <= docs.rdd.getNumPartitions()
    middle = found.total // 2
    assert (found.read(middle, 5) == table[middle : middle + 5]).all()


def test_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    check(docs, f"file://{tmp_path}/a", 128, 37)


def test_odd_rows(spark, tmp_path):
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (None, ""), (3, "word " * 9000), (None, "z")]
    docs = spark.createDataFrame(
        [(*r, 1, 2) for r in rows], "doc_id long, text string, slot long, tokens int"
    )
    check(docs, f"file://{tmp_path}/b", 16, 8)
    assert sh.materialise_documents(docs.limit(0)).manifest.count() == 0


def test_ids_that_do_not_fit():
    with pytest.raises(ValueError, match="does not fit"):
        sh.narrowed(np.array([70_000]))


def test_words_are_cut_as_bytes():
    own = Encoder(public_tokenizers.path(WORD_BPE))
    texts = ["A b\nÀÉ, é", "A <|endoftext|> B", "", " x  Y", "long " + "ab" * 300 + " \u0130 \u6f22"]
    for text, found in zip(texts, own.ids(texts), strict=True):
        assert found.tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids
    assert all(isinstance(word, bytes) for word in own.known)
