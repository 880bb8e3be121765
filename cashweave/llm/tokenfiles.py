"""Token ids as Parquet: encoded documents in files that can be read in part.

A token folder has two tables, both plain Parquet that any reader can open:

    tokens/   part, doc_id, at, n_tokens, ids (list of int), the end id last
    parts/    part, start, n_docs, n_tokens, least_id, greatest_id

Rows are in ascending doc_id order over all parts and within each. `at` is the number
of tokens before the row in its part, and `start` that before the part, so a row's place
in the whole stream is start + at without a second pass over the ids. Ids are
dictionary-encoded (their places in a vocabulary take 16 bits or fewer), the ascending
columns by deltas (Parquet's version 2 pages). Row groups and pages are small and fixed
in bytes, and every file has a column and an offset index: a reader of a few documents,
or of a range of the stream, opens the pages that hold them, and a reader of lengths
never opens the ids.

Texts are dealt by doc_id, so a part holds a range of ids; rows that share an id (or
have none) are in the order of the table and dealt by their number there, so that no id
is a part of its own. Encoding follows the deal: the texts are shuffled once,
and only ids are written.

Encoding is exact and by the tokenizers library. A word that the pre-tokenizer makes
never holds white space, so chunks between ASCII white space are encoded apart, and
those seen lately are remembered: so many bytes of them and what one batch brings.

Defined cases: a null or empty text has the end id only; null ids come first; rows of
one id keep the order of the table; repeated rows are rows; an empty table gives
an empty folder with the schema; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cashweave.llm.base import shared_folder, slices, table, unnamed

END = 2
#: Bytes of a row group and of a page before compression, and rows of a page.
GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2_000
#: Bytes of text that a part is for.
PART_BYTES = 64 << 20
#: Remembered chunks: the longest, and the bytes of all (texts and ids).
CHUNK_BYTES, MEMORY_BYTES = 48, 160 << 20
#: What a remembered chunk takes beside its bytes.
_ENTRY_BYTES = 120
#: Bytes of texts that are cut and looked up together.
BATCH_BYTES = 4 << 20
#: Bytes of unknown chunks that go to the library as one text.
_ASKED_BYTES = 1 << 15
_TABLES = {
    "tokens": "part int, doc_id long, at long, n_tokens long, ids array<int>",
    "parts": "part int, start long, n_docs long, n_tokens long, least_id long, greatest_id long",
}


# Latin letters, and what may follow them in a chunk: no apostrophe, which begins pieces of
# its own, and no "<", which begins added tokens. The first is one piece and the rest another.
_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")
_ENDS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'<")
_PROBES = ["A", "The", "thereis", "ÉTÉ", "naïveté", "Straße", "ÄÖÜ", "ñandúÑ", _LETTERS]


class Words:
    """A tokenizer that remembers the ids of short chunks.

    A chunk of Latin letters and punctuation is two pieces. The letters, lower-cased, are
    looked up by themselves, so a word is asked for once in all its forms, and from the
    library's BPE model directly. That is done only where probes show that the tokenizer
    treats such words so; it asks whole texts otherwise, and for all other chunks.
    """

    def __init__(self, path: str, memory: int = MEMORY_BYTES):
        # One text is asked for at a time: the library's pool would only be a thread for each
        # core of the machine in every task, and a switch of threads for each question.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        added = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items() if t.special}
        # A token between chunks tells them apart, unless they hold the beginning of one.
        self.between = min(added, key=len, default=None)
        self.between_id = added.get(self.between)
        self.marks = {a[:1].encode() for a in added}
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.mapped = {ord(c): bytewise.pre_tokenize_str(c)[0][0] for c in _LETTERS}
        self.memory, self.known, self.held = memory, {}, 0
        # The generation before, and the bytes of one of its chunks.
        self.old, self.average = {}, 0.0
        self.parts = all(self._letters(p.lower()) == self._ids(p).tobytes() and self._ids(p + ",.$").tolist() == [*self._ids(p), *self._ids(",.$")] for p in _PROBES)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.dtype("<u4"))

    def _letters(self, word: str) -> bytes:
        # Letters of ASCII are mapped to themselves.
        tokens = self.model.tokenize(word if word.isascii() else word.translate(self.mapped))
        return b"".join([t.id.to_bytes(4, "little") for t in tokens])

    def _ask(self, chunks: list[bytes]) -> Iterator[bytes]:
        """The ids of chunks that are asked for as one text."""
        ids = self._ids(f" {self.between} ".join(c.decode() for c in chunks))
        ends = np.append(np.flatnonzero(ids == self.between_id), len(ids))
        begins = np.append(0, ends[:-1] + 1)
        for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
            yield ids[a:b].tobytes()

    def _remember(self, chunk: bytes, ids: bytes) -> bytes:
        self.known[chunk] = ids
        self.held += len(chunk) + len(ids) + _ENTRY_BYTES
        return ids

    def _part(self, part: str, letters: bool) -> bytes:
        key = part.encode()
        ids = self.known.get(key)
        if ids is None:
            ids = self.old.get(key)
            if ids is None:
                ids = self._letters(part) if letters else self._ids(part).tobytes()
            self._remember(key, ids)
        return ids

    def learn(self, chunks: set[bytes]) -> None:
        """Ids of chunks that are not known."""
        again = chunks & self.old.keys()
        if again:
            self.known.update(zip(again, map(self.old.__getitem__, again), strict=True))
            self.held += int(len(again) * self.average)
        asked, size = [], 0
        known, old, part, tokenize, held = self.known, self.old, self._part, self.model.tokenize, 0
        for chunk in chunks - again:
            letters = chunk.rstrip(_ENDS) if self.parts else b""
            if letters.isalpha():  # bytes: A to Z only
                rest, low = chunk[len(letters) :], letters.lower()
                ids = known.get(low)
                if ids is None:
                    ids = old.get(low) or b"".join([t.id.to_bytes(4, "little") for t in tokenize(low.decode())])
                    known[low] = ids
                    held += len(low) + len(ids) + _ENTRY_BYTES
                if rest:
                    ids += known.get(rest) or part(rest.decode(), False)
                if rest or low != chunk:  # else it is known by now
                    known[chunk] = ids
                    held += len(chunk) + len(ids) + _ENTRY_BYTES
                continue
            word = _WORD.fullmatch(chunk.decode()) if self.parts else None
            if word:
                ids = self._part(word[1].lower(), True)
                if word[2] or chunk not in known:
                    self._remember(chunk, ids + self._part(word[2], False) if word[2] else ids)
            elif self.between is None or len(chunk) > CHUNK_BYTES or any(m in chunk for m in self.marks):
                self._remember(chunk, self._ids(chunk.decode()).tobytes())
            else:
                asked.append(chunk)
                size += len(chunk)
                if size >= _ASKED_BYTES:
                    self._learned(asked)
                    asked, size = [], 0
        if asked:
            self._learned(asked)
        self.held += held

    def _learned(self, asked: list[bytes]) -> None:
        for chunk, ids in zip(asked, self._ask(asked), strict=True):
            self._remember(chunk, ids)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of whole texts, as little-endian unsigned 32-bit integers."""
        cut = [t.split() for t in texts]  # bytes split at ASCII white space, and at nothing else
        self.learn(set(filterfalse(self.known.__contains__, set().union(*cut))))
        done = [b"".join(map(self.known.__getitem__, c)) for c in cut]
        if self.held > self.memory // 2:
            # What was used since the last change of generation stays for one more.
            long = [c for c in self.known if len(c) > CHUNK_BYTES]
            for chunk in long:
                del self.known[chunk]
            self.average = self.held / max(1, len(self.known) + len(long))
            self.old, self.known, self.held = self.known, {}, 0
        return done


_words: dict[str, Words] = {}


def _encoder(path: str, end: int):
    """(doc_id, text) in order to rows of the tokens table, `at` counted on over the task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _words:
            _words[path] = Words(path)
        words = _words[path]
        part, at, last = TaskContext.get().partitionId(), 0, np.array([end], "<u4").tobytes()
        for batch in batches:
            for lo, hi, data, places in slices(batch.column(1), BATCH_BYTES):
                raw = data.tobytes()
                ids = [i + last for i in words.encode([raw[a:b] for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)])]
                counts = np.array([len(i) // 4 for i in ids], np.int64)
                ends = np.cumsum(counts)
                flat = pa.array(np.frombuffer(b"".join(ids), "<u4").view(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), flat)
                columns = [pa.array(np.full(hi - lo, part, np.int32)), batch.column(0).slice(lo, hi - lo), pa.array(at + ends - counts), pa.array(counts), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "at", "n_tokens", "ids"])
                at += int(ends[-1]) if len(ends) else 0

    return rows


def _options(group: int = GROUP_BYTES, page: int = PAGE_BYTES, rows: int = PAGE_ROWS) -> dict[str, str]:
    """How the files are laid out. Version 2 pages code integers by deltas where no dictionary is asked for."""
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in ("part", "doc_id", "at", "n_tokens")}
    return {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": str(group),
        "parquet.page.size": str(page),
        "parquet.page.row.count.limit": str(rows),
        "parquet.enable.dictionary": "true",
        **plain,
    }


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = END, part_bytes: int = PART_BYTES, **layout: int) -> None:
    """Encode docs (doc_id, text) with the tokenizers file `tokenizer` into a token folder.

    layout: group, page (bytes) and rows (of a page). The parts table is written last: a
    folder that has it is whole.
    """
    spark = docs.sparkSession
    source = unnamed(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = source.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 32)).first()[0] or 0
    order = ["doc_id", "_row"]
    dealt = source.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(max(1, -(-size // part_bytes)), *order).sortWithinPartitions(*order)
    tokens = dealt.select("doc_id", "text").mapInArrow(_encoder(tokenizer, end), _TABLES["tokens"])
    tokens.write.options(**_options(**layout)).parquet(f"{path}/tokens")
    read = spark.read.schema(_TABLES["tokens"]).parquet(f"{path}/tokens")
    parts = read.groupBy("part").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.min("doc_id").alias("least_id"), F.max("doc_id").alias("greatest_id"))
    # One row a part, from the columns beside the ids.
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = parts.withColumn("start", F.coalesce(before, F.lit(0)))
    placed.select("part", "start", "n_docs", "n_tokens", "least_id", "greatest_id").coalesce(1).write.parquet(f"{path}/parts")


def _table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{path}/{name}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """part, doc_id, start (tokens of all documents before it), n_tokens and ids.

    The parts table has a row for each of so many bytes of text; it is joined as Spark
    sees fit by its size. Columns that are not selected are not read.
    """
    parts = _table(spark, path, "parts").select("part", F.col("start").alias("_start"))
    tokens = _table(spark, path, "tokens").join(parts, "part")
    return tokens.select("part", "doc_id", (F.col("_start") + F.col("at")).alias("start"), "n_tokens", "ids")


def documents_of(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of a few documents: only pages whose range of ids holds one of them are opened."""
    return _table(spark, path, "tokens").where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def stream_between(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """doc_id, start and ids of the tokens first to last - 1 of the stream, documents cut to the range.

    The parts that meet the range are looked up first; there are two whole conditions on
    `at` for each, so pages outside are skipped.
    """
    met = _table(spark, path, "parts").where((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first)).agg(F.min("part").alias("a"), F.max("part").alias("b"), F.min("start").alias("from"), F.max("start").alias("to")).first()
    tokens = read_tokens(spark, path)
    if met["a"] is None or last <= first:
        return tokens.where(F.lit(False)).select("doc_id", "start", "ids")
    inner = F.col("part").between(met["a"], met["b"])
    ahead = (F.col("part") > met["a"]) | (F.col("at") + F.col("n_tokens") > first - met["from"])
    behind = (F.col("part") < met["b"]) | (F.col("at") < last - met["to"])
    parts = _table(spark, path, "parts").select("part", F.col("start").alias("_start"))
    held = _table(spark, path, "tokens").where(inner & ahead & behind).join(parts, "part").withColumn("start", F.col("_start") + F.col("at"))
    cut_from, cut_to = F.greatest(F.lit(first) - F.col("start"), F.lit(0)), F.least(F.lit(last) - F.col("start"), F.col("n_tokens"))
    cut = F.slice("ids", (cut_from + 1).cast("int"), (cut_to - cut_from).cast("int"))
    return held.where((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first)).select("doc_id", (F.col("start") + cut_from).alias("start"), cut.alias("ids"))


def with_crc32(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32: unsigned, of ids as little-endian unsigned 32-bit integers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat, at = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4"), lists.offsets.to_numpy()
            raw = memoryview(flat.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return unnamed(tokens, "doc_id", "start", "n_tokens", "ids").mapInArrow(sums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return with_crc32(read_tokens(spark, path))
