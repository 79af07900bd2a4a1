"""Token files: round trip against the library, layout, order, edge rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from encore.llm import token_files as tf
from encore.llm.queries import TOKENIZER
from tests.conftest import SF


@pytest.fixture(scope="module")
def library():
    return tf.load_tokenizer(TOKENIZER)


def tie(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def want(library, rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1] or ""))):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_pieces_give_the_ids_of_the_whole_text(library, monkeypatch):
    monkeypatch.setattr(tf, "REMEMBERED", 8)
    encode = tf.Encoder(TOKENIZER, np.uint32)
    texts = ["", "  a  b\n\n c", "a \n b  ", "\x1c a\x1cb", "é  　x", "!\x85 a", "a\t b", "x  ", " <|endoftext|> a", "'s 's'll  I'll", "\n\na  \n", "🙂 🙂​ ​а", "१२ ३४ x²  ½", "don't\nstop  now "]
    for text in texts * 2:
        assert np.frombuffer(encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_documents_and_edge_rows(spark, tmp_dir, library):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = [(None, "no id"), (-3, None), (-3, None), (-2, ""), (10**12, "word " * 100_000), (5, "tie b"), (5, "tie a")]
    docs = given.union(spark.createDataFrame(odd, "doc_id long, text string")).withColumns({c: F.lit("x") for c in ("body", "shard", "part", "ids")})
    got = tf.token_files(docs, TOKENIZER, f"file://{tmp_dir}/t", length=64)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == want(library, rows)


def test_layout_is_fixed_size_lists_with_random_access(spark, tmp_dir, library):
    docs = spark.createDataFrame([(i, f"text {i} " * i) for i in range(40)], "doc_id long, text string")
    shards = tf.write_token_files(docs, f"file://{tmp_dir}/t", TOKENIZER, length=16, parts=3).orderBy("part").collect()
    every = []
    for s in shards:
        with pa.memory_map(f"{tmp_dir}/t/{s['shard']}.arrows") as m, pa.ipc.open_stream(m) as r:
            assert r.schema == tf.shard_schema(16, np.uint16)
            batch = r.read_next_batch()
        sequences, mask = tf.read_sequences(f"file://{tmp_dir}/t", s["shard"])
        assert sequences.shape == mask.shape and sequences.shape[1] == 16
        assert np.shares_memory(batch.column("sequence").flatten().to_numpy(), np.frombuffer(batch.column("sequence").flatten().buffers()[1], np.uint16))
        assert mask.sum() == s["ids"] and mask.reshape(-1)[: s["ids"]].all()
        every += sequences[mask].tolist()
    ids = [i for n in range(40) for i in [*library.encode(f"text {n} " * n, add_special_tokens=False).ids, 0]]
    assert every == ids


def test_sequences_by_position_share_the_memory_of_their_batch(spark, tmp_dir):
    docs = spark.createDataFrame([(i, f"text {i} " * i) for i in range(60)], "doc_id long, text string")
    tmp = f"{tmp_dir}/t"
    (shard,) = (s["shard"] for s in tf.write_token_files(docs, f"file://{tmp}", TOKENIZER, length=2, parts=1).collect())
    sequences = tf.Sequences(f"file://{tmp}", shard)
    ids, masks = tf.read_sequences(f"file://{tmp}", shard)
    assert len(sequences.batches) > 3 and len(sequences) == len(ids)
    for i in range(-1, len(sequences)):
        one, mask = sequences[i]
        assert one.tolist() == ids[i].tolist() and mask.to_pylist() == masks[i].tolist()
        at = int(np.searchsorted(sequences.first, i % len(sequences), side="right")) - 1
        batch = sequences.batches[at]
        assert np.shares_memory(one, batch.column("sequence").flatten().to_numpy())
        assert mask.buffers()[1].address == batch.column("mask").flatten().buffers()[1].address
    with pytest.raises(IndexError):
        sequences[len(sequences)]


def test_empty_table(spark, tmp_dir):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tf.token_files(docs, TOKENIZER, f"file://{tmp_dir}/t").collect() == []
