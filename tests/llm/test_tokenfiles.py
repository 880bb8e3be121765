"""Token folders: ids against the library, the layout of the files, reading them in part."""

import glob
import os
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from cashweave.llm import tokenfiles as tf

MODEL = tf.tokenizer_path()


def _ids(text):
    return [*Tokenizer.from_file(MODEL).encode(text or "", add_special_tokens=False).ids, tf.END]


@pytest.fixture(scope="module")
def written(spark, odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "odd")
    tf.write_tokens(odd, path, MODEL, part_bytes=100_000)
    return path


def test_odd_rows(spark, odd, written):
    want = sorted(((r["doc_id"], _ids(r["text"])) for r in odd.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    found = sorted(tf.read_tokens(spark, written).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [i for i, _ in want]
    assert sorted(((r["doc_id"], r["ids"]) for r in found), key=str) == sorted(want, key=str)
    at = 0
    for r in found:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        at += len(r["ids"])
    assert len({r["part"] for r in found}) > 1


def test_query_against_the_library(spark, small):
    rows = small.select("doc_id", "text").orderBy("doc_id").collect()
    done = {r["doc_id"]: r for r in tf.op12_token_files(spark, "/root/testdata/sf0.001").collect()}
    at = 0
    for r in rows:
        ids, got = _ids(r["text"]), done[r["doc_id"]]
        assert (got["start"], got["n_tokens"], got["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@pytest.mark.parametrize("memory", [0, 5_000, 1 << 24])
def test_chunks_are_exact(small, memory):
    """Special tokens, marks without a base, other white space, and a memory that is always full."""
    odd = ["a<|endoftext|>b <|startoftext|>", "< |endoftext|>", "é ́x é", "ΟΔΟΣ Σας", "a b　c\x1cd\x85e", "'s it's 'S", "x" * 5000, " \t\n", "", "漢字🙂▁ " * 50, "Word WORD, word... wörd; ÄRGER:$$$ ßtraße ÿ ÀÉ×÷a naïve'll don't", "É́ à la:", "a1 b_c d-e f<g h|i µm ªº"]
    texts = odd + [r["text"] or "" for r in small.limit(40).collect()]
    words = tf.Words(MODEL, memory)
    plain = Tokenizer.from_file(MODEL)
    for _ in range(2):  # with what is remembered too
        for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert words.parts
    assert words.held <= memory // 2


def test_remembered_bytes_are_counted_once(small):
    """A word of small letters is its own first piece, and one entry."""
    words = tf.Words(MODEL)
    words.encode([b"plain words in Mixed CASE, twice: plain, w\xc3\xb6rter W\xc3\xb6rter w\xc3\xb6rter.", *((r["text"] or "").encode() for r in small.limit(40).collect())])
    assert words.held == sum(len(c) + len(i) + tf._ENTRY_BYTES for c, i in words.known.items())


def test_probes_decide(small):
    """Where words are not what they seem, whole chunks are asked for."""
    words = tf.Words(MODEL)
    words.parts = False
    texts = [r["text"] or "" for r in small.limit(20).collect()]
    for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == _ids(text)[:-1]


def test_layout(spark, small, tmp_path):
    """Dictionary codes for ids, deltas for ascending columns, pages and groups of a set size, indexes."""
    path = str(tmp_path / "laid")
    tf.write_tokens(small, path, MODEL, group=200_000, page=4_096, rows=16)
    files = glob.glob(f"{path}/tokens/*.parquet")
    groups = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema.split(".")[0]: meta.row_group(g).column(c) for c in range(5)}
            assert "RLE_DICTIONARY" in columns["ids"].encodings
            assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and "DELTA_BINARY_PACKED" in columns["at"].encodings
            assert all(c.has_column_index and c.has_offset_index for c in columns.values())
            assert columns["doc_id"].statistics.min is not None
    assert groups > 1


def test_reads_in_part(spark, small, written, tmp_path):
    path = str(tmp_path / "part")
    tf.write_tokens(small, path, MODEL, part_bytes=60_000)
    rows = sorted(tf.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert len({r["part"] for r in rows}) > 2
    stream = [i for r in rows for i in r["ids"]]
    for first, last in ((0, 1), (0, len(stream)), (777, 30_001), (rows[9]["start"], rows[10]["start"]), (len(stream) - 3, len(stream) + 50), (5, 5), (len(stream), len(stream) + 1)):
        got = sorted(tf.stream_between(spark, path, first, last).collect(), key=lambda r: r["start"])
        assert [i for r in got for i in r["ids"]] == stream[first:last]
        assert all(stream[r["start"] : r["start"] + len(r["ids"])] == r["ids"] for r in got)
    some = [rows[3]["doc_id"], rows[77]["doc_id"], -1]
    picked = tf.documents_of(spark, path, some)
    assert {r["doc_id"]: r["ids"] for r in picked.collect()} == {r["doc_id"]: r["ids"] for r in rows if r["doc_id"] in some}
    plan = picked._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id" in plan
    lengths = tf.read_tokens(spark, path).select("doc_id", "start", "n_tokens")._jdf.queryExecution().toString()
    assert "ids:array" not in lengths.split("== Physical Plan ==")[1]


def test_empty(spark, none, tmp_path):
    path = str(tmp_path / "none")
    tf.write_tokens(none, path, MODEL)
    assert tf.read_tokens(spark, path).collect() == []
    assert tf.stream_between(spark, path, 0, 10).collect() == []
    assert tf.with_crc32(tf.read_tokens(spark, path)).collect() == []


def test_words_are_asked_for_in_the_task_itself():
    """The library starts no threads of its own; told in a process that has none of them yet."""
    code = (
        "import os, sys\n"
        "import tokenizers\n"
        "from cashweave.llm import tokenfiles as tf\n"
        "before = len(os.listdir('/proc/self/task'))\n"
        "assert len(tf.Words(sys.argv[1]).encode([b\"it isn't one word\"])) == 1\n"
        "assert len(os.listdir('/proc/self/task')) == before\n"
    )
    env = os.environ | {"PYTHONPATH": str(Path(tf.__file__).parents[2])}
    subprocess.run([sys.executable, "-c", code, MODEL], check=True, env=env, timeout=120)
