import random
import struct
import tracemalloc

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from cashweave.llm import pieces

PATH = pieces.model_path()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def _texts():
    rng = random.Random(3)
    odd = ["", " ", "  a", "a  ", "▁x", "x▁▁ y", "é漢字🙂🙂\x01 z", "\n\n\t a\r\n", "<s> </s> <unk> <0x41>", "a" * 400, "  " * 50 + "b", "日本語" * 200, "🙂" * 100]
    return odd + ["".join(rng.choice(" ▁abe\n🙂é漢.,<>0x ") for _ in range(rng.randint(0, 60))) for _ in range(300)]


def test_equals_the_library(library, small):
    own = pieces.Pieces(PATH, memory=50)  # so that chunks are forgotten and come again
    texts = _texts() + [r["text"] or "" for r in small.select("text").collect()]
    for text in texts:
        ids, begins, ends, decoded = own.encode(text)
        assert ids.tolist() == library.encode(text, add_eos=True)
        assert decoded == library.decode(ids.tolist()) == own.decode(ids.tolist())
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(begins.tolist(), ends.tolist(), strict=True))[:-1] == spans


def test_memory_is_bounded_in_bytes(library):
    """However long and many the chunks are; many texts at once are as each by itself."""
    own, rng = pieces.Pieces(PATH, memory=1 << 20), random.Random(7)
    word = lambda n: "".join(rng.choices("abcdeßé漢\n.,#", k=n))
    texts = [" ".join(word(rng.randint(1, 60)) for _ in range(400)) for _ in range(60)] + [word(20_000) for _ in range(8)]
    tracemalloc.start()
    for text in texts:
        assert own.encode(text)[0].tolist() == library.encode(text, add_eos=True)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 3 << 20
    first, ids, begins, ends, decoded = own.encode_all([t.encode() for t in ["", *texts]])
    for k, text in enumerate(["", *texts]):
        one = slice(first[k], first[k + 1])
        for found, alone in zip((ids[one], begins[one], ends[one]), pieces.Pieces.encode(own, text), strict=False):
            assert np.array_equal(found, alone)
        assert decoded[k].decode() == library.decode(ids[one].tolist())


def test_short_chunks_are_merged_together(library, monkeypatch):
    """No short chunk takes the way of the long ones."""
    own, rng = pieces.Pieces(PATH), random.Random(11)
    monkeypatch.setattr(own, "_merge", None)
    text = " ".join("".join(rng.choices("abcdeinrstuéß漢\n.,", k=rng.randint(1, pieces.SHORT - 1))) for _ in range(5_000))
    assert own.encode(text)[0].tolist() == library.encode(text, add_eos=True)


@pytest.mark.parametrize("bytewise", [True, False])
def test_characters_that_are_no_pieces(tmp_path, bytewise):
    """Some stand in longer pieces, one has a tie of scores beside it; with byte pieces and without."""
    model = pb.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    gone = {"q", "x", "é"}
    kept = [p for p in model.pieces if p.piece not in gone and (bytewise or p.type != pieces.BYTE)]
    for p in kept:
        p.score = -100.0 if p.piece in ("qu", "ue", "ex") else p.score
    del model.pieces[:]
    model.pieces.extend(kept)
    model.trainer_spec.byte_fallback = bytewise
    path = tmp_path / "own.model"
    path.write_bytes(model.SerializeToString())
    library, own, rng = sentencepiece.SentencePieceProcessor(model_file=str(path)), pieces.Pieces(str(path)), random.Random(13)
    for _ in range(300):
        text = "".join(rng.choices("qxéue ant\U0001f642漢", k=rng.randint(0, 70)))
        ids, _, ends, decoded = own.encode(text)
        if bytewise:
            assert ids.tolist() == library.encode(text, add_eos=True)
            assert decoded == library.decode(ids.tolist())
        assert not len(ids) > 1 or ends[-2] == len(text.encode())
        for chunk in (c for c in own.known if len(c) < 30):
            assert own.known[chunk] == own._chunk(pieces._marked(chunk))  # as by the heap


def _trie(entries: dict[bytes, int]) -> list[int]:
    """A double array of the model files' form, places taken first come first served."""
    units, taken = {0: 0}, {0}

    def fill(node: int, keys: list[tuple[bytes, int]]) -> None:
        labels = sorted({k[0] if k else 0 for k, _ in keys})
        base = next(b for b in range(1, 1 << 20) if all((node ^ b ^ x) not in taken for x in labels))
        units[node] = units.get(node, 0) | base << 10 | (256 if 0 in labels else 0)
        for x in labels:
            taken.add(node ^ base ^ x)
        for x in labels:
            at = node ^ base ^ x
            if x == 0:
                units[at] = 1 << 31 | next(v for k, v in keys if not k)
            else:
                units[at] = x
                fill(at, [(k[1:], v) for k, v in keys if k and k[0] == x])

    fill(0, sorted(entries.items()))
    return [units.get(i, 0) for i in range((max(units) | 255) + 1)]


@pytest.mark.parametrize("trim", [False, True])
def test_character_map_and_offsets(tmp_path, trim):
    table = {"ﬁ": "fi", "Ａ": "A", "ab": "X", "abc": "yz", "é": "é", "　": " ", "​": ""}
    strings, entries = b"", {}
    for key, value in table.items():
        entries[key.encode()] = len(strings)
        strings += value.encode() + b"\0"
    blob = b"".join(struct.pack("<I", u) for u in _trie(entries))
    model = pb.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.normalizer_spec.precompiled_charsmap = struct.pack("<I", len(blob)) + blob + strings
    model.normalizer_spec.remove_extra_whitespaces = trim
    path = tmp_path / "own.model"
    path.write_bytes(model.SerializeToString())
    library, own = sentencepiece.SentencePieceProcessor(model_file=str(path)), pieces.Pieces(str(path))
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice(["ﬁ", "Ａ", "a", "b", "c", "é", "　", " ", "​", "漢", "z"]) for _ in range(rng.randint(0, 25)))
        ids, begins, ends, _ = own.encode(text)
        assert ids.tolist() == library.encode(text, add_eos=True), text
        raw = text.encode()
        assert all(0 <= a <= b <= len(raw) for a, b in zip(begins.tolist(), ends.tolist(), strict=True))
        if len(ids) > 1 and not trim:
            assert ends[-2] == len(raw)


def test_odd_rows_round_trip(odd):
    encoded = pieces.encode(odd, PATH)
    texts = sorted((r["text"] or "").replace("▁", " ") for r in odd.select("text").collect())  # the mark itself decodes to a space
    assert sorted(r["text"] for r in pieces.decode(encoded, PATH).collect()) == texts
    assert sorted(r["decoded"] for r in encoded.collect()) == texts


def test_empty(none):
    assert pieces.encode(none, PATH).collect() == []
