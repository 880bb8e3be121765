"""SentencePiece encoding and decoding with byte offsets into the original text.

A model file's parts are read as they are: the compiled character map (a double-array
trie and its replacement strings), the pieces with their scores, and the flags. Text
is normalised by the longest prefix found in the map at each place, and every byte of
the result keeps the place it came from; so each piece projects to a span of bytes of
the original text. The pieces come from the merges of byte-pair encoding: again and
again the neighbouring pair that forms the piece of the highest score, leftmost first.

If no piece goes on with the space mark after another character, as in most models,
merges never cross into the next run of space marks. Such chunks are then encoded by
themselves and remembered, and a chunk costs one look-up when it comes again. The
memory has two generations of so many bytes, so frequent chunks stay. Unknown short
chunks are merged together: each round does the next merge of every one of them.

Tasks need the model file at the same path on every machine; the path is a parameter.

Defined cases: a null text is an empty one; an empty text has no pieces but the end id;
characters that are no piece become byte pieces (or the unknown id in models without
them); repeated rows and null ids are rows; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.llm.base import slices, table, unnamed

MARK = "▁"
#: Remembered chunks: the bytes of all, the longest, and what one takes beside its bytes.
MEMORY, CHUNK_BYTES = 64 << 20, 48
_ENTRY_BYTES = 120
#: Bytes of texts that are cut and looked up together.
BATCH_BYTES = 2 << 20
#: Characters of chunks that are merged together, and how many chunks are.
SHORT, ROWS = 32, 4096
#: The space mark in chunks, a byte that UTF-8 never has.
_MARK_BYTE = b"\xff"
#: What fills rows of symbols up, and the bits of a symbol.
_BITS = 21
_FILL = (1 << _BITS) - 1
_SPREAD = 0x9E3779B97F4A7C15
#: A piece in a text: its id and its bytes in the normalised text.
_CELL = np.dtype([("id", "<i4"), ("width", "<u2")])
#: Kinds of pieces in model files.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_ENCODED = "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string"


class CharMap:
    """Longest-prefix replacement by a compiled map; an empty map copies everything."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.strings = blob[4 + size :]
        # Bytes that begin no entry are copied in runs.
        first = bytes(b for b in range(1, 256) if self._step(self._root(), b) is not None) if self.units else b""
        self.copied = re.compile(b"[^" + re.escape(first) + b"]+" if first else b"(?s:.+)")

    def _root(self) -> int:
        return self._offset(self.units[0])

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def _step(self, node: int, byte: int) -> tuple[int, int] | None:
        """(next node, its unit) along a byte, if the trie has it."""
        node ^= byte
        if node >= len(self.units):
            return None
        unit = self.units[node]
        if unit & ((1 << 31) | 0xFF) != byte:
            return None
        return node ^ self._offset(unit), unit

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest entry that begins at `at`."""
        node, found = self._root(), None
        for i in range(at, len(text)):
            step = self._step(node, text[i])
            if step is None:
                break
            node, unit = step
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, value = found
        return length, self.strings[value : self.strings.index(0, value)]

    def replace(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The text normalised, and for each of its bytes and its end the place in the original."""
        if not self.units:
            return text, np.arange(len(text) + 1)
        parts, places, at = [], [], 0
        while at < len(text):
            if run := self.copied.match(text, at):
                stop = run.end()
                while stop < len(text) and text[stop] & 0xC0 == 0x80:
                    stop += 1
                parts.append(text[at:stop])
                places.append(np.arange(at, stop))
                at = stop
                continue
            hit = self.longest(text, at)
            if hit is None:
                stop = at + 1
                while stop < len(text) and text[stop] & 0xC0 == 0x80:
                    stop += 1
                hit = stop - at, text[at:stop]
                places.append(np.arange(at, stop))
            else:
                places.append(np.full(len(hit[1]), at))
            parts.append(hit[1])
            at += hit[0]
        return b"".join(parts), np.concatenate([*places, [len(text)]]).astype(np.int64)


class Pieces:
    """The encoder and decoder of one model file."""

    def __init__(self, path: str, memory: int = MEMORY):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != model.trainer_spec.BPE:
            raise ValueError(f"{path}: only models of byte-pair encoding are read")
        spec = model.normalizer_spec
        self.prefix = spec.add_dummy_prefix
        self.trim = spec.remove_extra_whitespaces
        self.map = CharMap(spec.precompiled_charsmap)
        self.names = [p.piece for p in model.pieces]
        self.kinds = [p.type or NORMAL for p in model.pieces]
        self.ids = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if self.kinds[i] in (NORMAL, USER, UNUSED)}
        self.raw = [self._raw(n, k) for n, k in zip(self.names, self.kinds, strict=True)]
        self.texts = pa.array(self.raw, pa.large_binary())
        self.unknown = self.kinds.index(UNKNOWN)
        self.end = self.names.index("</s>")
        self.bytes = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(self.names, self.kinds, strict=True)) if k == BYTE}
        user = sorted((n for n, k in zip(self.names, self.kinds, strict=True) if k == USER), key=len, reverse=True)
        self.user = re.compile("(" + "|".join(map(re.escape, user)) + ")") if user else None
        unused = any(k == UNUSED for k in self.kinds)
        if unused:
            raise ValueError(f"{path}: unused pieces are not supported")
        apart = not user and not any(MARK in n.lstrip(MARK) for n in self.ids)
        self.chunks = re.compile(rb"\xff*[^\xff]+|\xff+" if apart else rb"(?s).+")
        self.memory, self.known, self.old, self.held = memory, {}, {}, 0
        self._symbols()

    def _symbols(self) -> None:
        """Numbers for symbols: a piece has its id, other characters have numbers behind; and what pairs of them form."""
        # The cells of symbols end to end (start, size), and the symbol of each character met so far.
        self.cells = np.array([(i, len(n.encode())) for i, n in enumerate(self.names)], _CELL)
        self.start, self.size = np.arange(len(self.names)), np.ones(len(self.names), np.int64)
        self.characters = np.full(0x110000, -1, np.int32)
        self._meet(sorted({c for n in self.ids for c in n}))
        number = {n: i for n, (i, _) in self.ids.items()} | {chr(c): int(self.characters[c]) for c in np.flatnonzero(self.characters >= 0).tolist()}
        pairs = {number[n[:k]] << _BITS | number[n[k:]]: i for n, (i, _) in self.ids.items() for k in range(1, len(n)) if n[:k] in number and n[k:] in number}
        # A table with open places, the next one when one is taken; -1 is an open one.
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.places = np.uint64(64 - bits), 1 << bits
        keys, formed = [-1] * self.places, [-1] * self.places
        for pair, piece in pairs.items():
            at = (pair * _SPREAD & (1 << 64) - 1) >> 64 - bits
            while keys[at] >= 0:
                at = (at + 1) % self.places
            keys[at], formed[at] = pair, piece
        self.pairs, self.formed = np.array(keys, np.int64), np.array(formed, np.int64)
        # By piece; the last is for pairs that form none.
        self.scores = np.full(len(self.names) + 1, -np.inf)
        for i, score in self.ids.values():
            self.scores[i] = score

    def _meet(self, characters: list[str]) -> None:
        """Symbols for characters that have none."""
        for c in characters:
            if c in self.ids:
                self.characters[ord(c)] = self.ids[c][0]
        others = [c for c in characters if c not in self.ids]
        self.characters[[ord(c) for c in others]] = len(self.start) + np.arange(len(others))
        cells = [self._other(c) for c in others]
        size = np.array([len(c) // _CELL.itemsize for c in cells], np.int64)
        self.start = np.append(self.start, len(self.cells) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.cells = np.append(self.cells, np.frombuffer(b"".join(cells), _CELL))

    @staticmethod
    def _raw(name: str, kind: int) -> bytes:
        """What a piece decodes to, as bytes."""
        if kind == BYTE:
            return bytes([int(name[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else name.replace(MARK, " ").encode()

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised text with space marks, place in the original of every byte and the end)."""
        out, place = self.map.replace(text)
        if not out:
            return b"", np.zeros(1, np.int64)
        data = np.frombuffer(out, np.uint8)
        if self.trim:
            space = data == 0x20
            keep = ~space | np.append(~space[1:], False)  # the last of several spaces, and none at the end
            first = np.argmax(~space) if (~space).any() else len(space)
            keep[:first] = False
            place = np.append(place[:-1][keep], place[np.flatnonzero(keep)[-1] + 1] if keep.any() else 0)
            data = data[keep]
            if not len(data):
                return b"", np.zeros(1, np.int64)
        mark = MARK.encode()
        width = np.where(data == 0x20, 3, 1)
        place = np.append(np.repeat(place[:-1], width), place[-1])
        out = data.tobytes().replace(b" ", mark)
        if self.prefix:
            out, place = mark + out, np.concatenate([np.full(3, place[0]), place])
        return out, place

    def _form(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pieces that pairs of symbols form, -1 for none."""
        pair = (left << _BITS | right).reshape(-1)
        with np.errstate(over="ignore"):
            at = ((pair.view(np.uint64) * np.uint64(_SPREAD)) >> self.shift).view(np.int64)
        key = self.pairs[at]
        out = np.where(key == pair, self.formed[at], -1)
        open_ = np.flatnonzero((key != pair) & (key >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % self.places
            key = self.pairs[at[open_]]
            hit = key == pair[open_]
            out[open_[hit]] = self.formed[at[open_[hit]]]
            open_ = open_[~hit & (key >= 0)]
        return out.reshape(left.shape)

    def _merge_rows(self, rows: np.ndarray) -> np.ndarray:
        """Rows of symbols, filled up by one place at least, after all merges."""
        done, live, columns = np.empty_like(rows), np.arange(len(rows)), np.arange(rows.shape[1] - 1)
        formed = self._form(rows[:, :-1], rows[:, 1:])
        while len(live):
            scores = self.scores[formed]
            at = scores.argmax(axis=1)  # the leftmost of the best
            open_ = scores[np.arange(len(live)), at] > -np.inf
            if not open_.all():
                done[live[~open_]] = rows[~open_]
                rows, formed, at, live = rows[open_], formed[open_], at[open_], live[open_]
            each, later = np.arange(len(live)), columns > at[:, None]
            piece = formed[each, at]
            rows[:, :-1] = np.where(later, rows[:, 1:], rows[:, :-1])
            formed[:, :-1] = np.where(later[:, :-1], formed[:, 1:], formed[:, :-1])
            formed[:, -1] = -1
            rows[each, at] = piece
            formed[each, at] = self._form(piece, rows[each, at + 1])
            each, at, piece = each[at > 0], at[at > 0] - 1, piece[at > 0]
            formed[each, at] = self._form(rows[each, at], piece)
        return done

    def _merge(self, text: str) -> list[str]:
        """The same order from a heap over linked symbols, for one text of any length."""
        symbols, ids = list(text), self.ids
        left, right = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            hit = ids.get(symbols[i] + symbols[j])
            if hit is not None:
                heapq.heappush(heap, (-hit[1], i, j, symbols[i] + symbols[j]))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if not symbols[i] or right[i] != j or not symbols[j] or symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j] = both, ""
            right[i] = right[j]
            if right[i] < len(symbols):
                left[right[i]] = i
                offer(i, right[i])
            if left[i] >= 0:
                offer(left[i], i)
        return [s for s in symbols if s]

    def _chunk(self, chunk: str) -> bytes:
        """The cells of one chunk."""
        if self.user is None:
            symbols = self._merge(chunk)
        else:
            symbols = [p for k, part in enumerate(self.user.split(chunk)) for p in ([part] if k % 2 else self._merge(part)) if p]
        return b"".join([self.cells[self.ids[p][0]].tobytes() if p in self.ids else self._other(p) for p in symbols])

    def _other(self, symbol: str) -> bytes:
        """A character that is no piece: its bytes, whose spans end where the character ends."""
        raw = symbol.encode()
        if not self.bytes:
            return _cell(self.unknown, len(raw))
        return b"".join([*(_cell(self.bytes[b], 0) for b in raw[:-1]), _cell(self.bytes[raw[-1]], len(raw))])

    def _learn(self, chunks: set[bytes]) -> None:
        """The cells of chunks that are not known."""
        again = chunks & self.old.keys()
        self._remember(list(again), list(map(self.old.__getitem__, again)))
        fresh = list(chunks - again)
        if not fresh:
            return
        joined = b"".join(fresh)
        size = np.fromiter(map(len, fresh), np.int64, len(fresh))
        begins_character = (np.frombuffer(joined, np.uint8) & 0xC0) != 0x80
        counts = np.add.reduceat(begins_character, np.cumsum(size) - size, dtype=np.int64)
        codes = np.frombuffer(_marked(joined).encode("utf-32-le"), "<u4")
        symbols = self.characters[codes].astype(np.int64)
        if (symbols < 0).any():
            self._meet(list(map(chr, np.unique(codes[symbols < 0]).tolist())))
            symbols = self.characters[codes].astype(np.int64)
        first = np.cumsum(counts) - counts
        symbols = np.append(symbols, np.full(SHORT + 1, _FILL))
        order = np.argsort(counts, kind="stable")
        short = int(np.searchsorted(counts[order], SHORT, "right")) if self.user is None else 0
        for lo in range(0, short, ROWS):
            some = order[lo : min(short, lo + ROWS)]
            columns = np.arange(counts[some[-1]] + 1)
            rows = np.where(columns < counts[some][:, None], symbols[first[some][:, None] + columns], _FILL)
            rows = self._merge_rows(rows)
            full = rows != _FILL
            flat = rows[full]
            total = np.cumsum(self.size[flat])
            raw = self.cells[np.repeat(self.start[flat] - total + self.size[flat], self.size[flat]) + np.arange(total[-1])].tobytes()
            edges = [0, *(total[np.cumsum(full.sum(axis=1)) - 1] * _CELL.itemsize).tolist()]
            self._remember([fresh[k] for k in some.tolist()], [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)])
        long = [fresh[k] for k in order[short:].tolist()]
        self._remember(long, [self._chunk(_marked(c)) for c in long])

    def _remember(self, chunks: list[bytes], cells: list[bytes]) -> None:
        self.known.update(zip(chunks, cells, strict=True))
        self.held += sum(map(len, chunks)) + sum(map(len, cells)) + _ENTRY_BYTES * len(chunks)

    def _forget(self) -> None:
        """What was used since the last change of generation stays for one more."""
        for chunk in [c for c in self.known if len(c) > CHUNK_BYTES]:
            del self.known[chunk]
        self.old, self.known, self.held = self.known, {}, 0

    def _text(self, ids) -> str:
        """Pieces as text, the space marks as spaces and all of them kept."""
        return _replaced(b"".join([self.raw[i] for i in ids]))

    def decode(self, ids) -> str:
        text = self._text(ids)
        return text[1:] if (self.prefix or self.trim) and text[:1] == " " else text

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
        """(ids with the end id, begin and end byte of each in the text, the ids decoded)."""
        _, ids, begins, ends, decoded = self.encode_all([text.encode()])
        return ids, begins, ends, decoded[0].decode()

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """(first[d] to first[d + 1] are the ids of text d, ids, begins, ends, the texts decoded)."""
        normal, places = zip(*map(self.normalise, texts), strict=True)
        mark, cut = MARK.encode(), self.chunks.findall
        chunks = [cut(n.replace(mark, _MARK_BYTE)) for n in normal]
        self._learn(set(filterfalse(self.known.__contains__, set().union(*chunks))))
        known = self.known.__getitem__
        cells = [b"".join(map(known, c)) for c in chunks]
        if self.held > self.memory // 2:
            self._forget()
        counts = np.array([len(c) // _CELL.itemsize for c in cells], np.int64)
        flat = np.frombuffer(b"".join(cells), _CELL)
        owner = np.repeat(np.arange(len(texts)), counts)
        # Each text's places have one more, for its end.
        ends = np.cumsum(flat["width"], dtype=np.int64) + owner
        place = np.concatenate(places)
        first = np.concatenate([[0], np.cumsum(counts)])
        raw = self.texts.take(pa.array(flat["id"]))
        at = np.frombuffer(raw.buffers()[1], np.int64)[: len(flat) + 1][first].tolist() if len(flat) else [0] * len(first)
        data, cut_off = (raw.buffers()[2] or b"") if len(flat) else b"", self.prefix or self.trim
        decoded = [bytes(data[a + (cut_off and data[a : a + 1] == b" ") : b]) if a < b else b"" for a, b in zip(at[:-1], at[1:], strict=True)]
        # The end id stands behind the last byte of a text that has pieces.
        last, size = first[1:], np.array([len(t) if n else 0 for t, n in zip(texts, counts.tolist(), strict=True)], np.int64)
        ids = np.insert(flat["id"], last, self.end)
        begins, ends = np.insert(place[ends - flat["width"]], last, size), np.insert(place[ends], last, size)
        return first + np.arange(len(first)), ids, begins, ends, decoded


def _cell(piece: int, width: int) -> bytes:
    return np.array([(piece, width)], _CELL).tobytes()


def _marked(chunks: bytes) -> str:
    return chunks.replace(_MARK_BYTE, MARK.encode()).decode()


def _replaced(raw: bytes) -> str:
    """UTF-8 as text; every byte that is not part of a character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError as e:
        return raw[: e.start].decode() + "�" + _replaced(raw[e.start + 1 :])


_models: dict[str, Pieces] = {}


def _model(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (the end id last), begins and ends (bytes in the text), and the ids decoded."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for whole in batches:
            for lo, hi, data, at in slices(whole.column(1), BATCH_BYTES):
                raw, at = data.tobytes(), at.tolist()
                first, *columns, decoded = pieces.encode_all([raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)])
                lists = [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(c.astype(np.int32))) for c in columns]
                yield pa.RecordBatch.from_arrays([whole.column(0).slice(lo, hi - lo), *lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "begins", "ends", "decoded"])

    source = unnamed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return source.mapInArrow(batches_of, _ENCODED)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with ids; the inverse of encode for texts that the map leaves as they are."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pieces.decode(i or []) for i in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return unnamed(encoded, "doc_id", "ids").mapInArrow(batches_of, "doc_id long, text string")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode(table(spark, sf_dir, "documents"), model_path())
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.when(F.size("ends") > 1, F.element_at("ends", -1)).otherwise(0).cast("long").alias("source_bytes"),
    )
