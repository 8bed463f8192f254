"""What the workers of the token and near-duplicate steps hold, during their tasks and afterwards."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from turnstone.llm import common, token_output


@pytest.fixture
def path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_remembered_words_take_few_bytes(path):
    r = random.Random(1)
    words = {"".join(r.choice("abcdefghij") for _ in range(7)) for _ in range(60_000)}
    encoder = token_output.Encoder(path)
    texts = pa.array([" ".join(words)])
    encoder.encode_all(pa.array([" " * len(texts[0].as_py())]))
    token_output.Texts(texts)  # powers for texts of this length
    tracemalloc.start()
    try:
        encoder.encode_all(texts)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 80 * len(words)


def test_workers_give_back_memory(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    run = common.lean(lambda batches: (b + 1 for b in batches))
    assert list(run(iter([1, 2]))) == [2, 3] and calls == [1]
    stopped = run(iter([1, 2]))
    next(stopped)
    stopped.close()
    assert calls == [1, 1]
    monkeypatch.undo()
    common.give_back()


def test_slices_are_bounded_in_bytes():
    texts = pa.array(["x" * 50, None, "", "y" * 300, "é" * 30, *["z"] * 9])
    got = [(a, b) for a, b in common.sized_slices(texts, 4, 100)]
    assert [i for a, b in got for i in range(a, b)] == list(range(len(texts)))
    sizes = [sum(len((t or "").encode()) for t in texts.to_pylist()[a:b]) for a, b in got]
    assert all(b - a <= 4 and (s <= 100 or b - a == 1) for (a, b), s in zip(got, sizes, strict=True))
    assert list(common.sized_slices(texts.slice(0, 0), 4, 100)) == []


def test_words_of_letters_and_others(path):
    """Letters, letter-like signs, marks and long words, through two generations, against whole texts."""
    from tokenizers import Tokenizer

    r = random.Random(2)
    pool = [*"abcXYZ", "é", "É", "ß", "ÿ", "×", "÷", "ª", "µ", "é", "Ā", "ſ", "İ", "9", "'s", "&", ".", "\x01", "<", "/w>"]
    words = ["".join(r.choice(pool) for _ in range(r.randint(1, 5))) for _ in range(6000)] + ["abé" * 40, "\x01", "</w>"]
    texts = [" ".join(r.choice(words) for _ in range(20)) for _ in range(1500)]
    encoder, plain = token_output.Encoder(path), Tokenizer.from_file(path)
    encoder.LIMIT = 700
    got = [x for i in range(0, len(texts), 100) for x in encoder.encode_all(pa.array(texts[i : i + 100]))]
    assert got == [np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for t in texts]
    assert len(encoder.older) and encoder.last.any()
    encoder = token_output.Encoder(path)
    encoder.last[:] = False
    assert encoder.encode_all(pa.array(texts[:50])) == got[:50]


def peak_of(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_batches_take_little_memory(path):
    """The arrays of a batch, and what remembering its words takes, don't grow with the rows that Spark sends."""
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(5000)]
    texts = pa.array([" ".join(r.choices(words, k=300)) for _ in range(2000)])
    encoder = token_output.Encoder(path)
    encoder.encode_all(texts.slice(0, 100))

    def run():
        for start, end in token_output.sized_slices(texts, token_output.BATCH_DOCS, token_output.BATCH_BYTES):
            encoder.encode_all(texts.slice(start, end - start))

    assert texts.nbytes > 4 << 20
    assert peak_of(run) < 48 << 20


def test_unknown_words_are_encoded_in_bounded_calls(path, monkeypatch):
    r = random.Random(4)
    words = ["".join(r.choice("abcdeé.9") for _ in range(r.randint(1, 12))) for _ in range(30_000)]
    texts = pa.array([" ".join(words[i : i + 50]) for i in range(0, len(words), 50)])
    encoder, calls = token_output.Encoder(path), []
    want = encoder.whole(texts)
    ids = encoder.ids
    monkeypatch.setattr(encoder, "ids", lambda text: calls.append(len(text.encode())) or ids(text))
    assert encoder.encode_all(texts) == want
    assert max(calls) <= 2 * (64 << 10) < sum(calls)


def test_long_words_end_a_generation(path):
    """Words of very many ids don't pile up."""
    r = random.Random(5)
    encoder = token_output.Encoder(path)
    texts = ["".join(r.choices("0123456789", k=400_000)) for _ in range(24)]
    for t in texts:
        got = encoder.encode(t)
    assert got == encoder.whole(pa.array(texts[-1:]))[0]
    assert 0 < len(encoder.newer.ids) + len(encoder.older.ids) < 2 * (8 * 500_000 + 400_001) + 2 < 24 * 400_000


def test_shards_are_read_a_document_at_a_time():
    raw = bytes(1_000_000)
    frame = token_output.zstandard.ZstdCompressor(level=1).compress(raw)
    n = 40
    payload = token_output.pack([*range(n - 1), None], [frame] * n, [250_000] * n, 0)
    batch = pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([5], pa.int64()), pa.array([payload])], names=["part", "first", "payload"])
    out = []
    peak = peak_of(lambda: out.extend(token_output._shard_reader(b"", {2: 100}, False)(iter([batch]))))
    rows = out[0].to_pylist()
    assert [x["doc_id"] for x in rows] == [*range(n - 1), None]
    assert [x["start"] for x in rows] == [105 + 250_000 * i for i in range(n)]
    assert {(x["n_tokens"], x["ids_crc32"]) for x in rows} == {(250_000, token_output.zlib.crc32(raw))}
    assert peak < 8 * len(raw)


def test_keys_do_not_depend_on_segments(monkeypatch):
    from turnstone.llm import wordarrays

    r = random.Random(6)
    texts = pa.array([" ".join("".join(r.choices("abcé", k=r.randint(1, 9))) for _ in range(60_000)), "x" * 70_000 + " y", None, "z"])
    keys = wordarrays.Texts(texts).key
    monkeypatch.setattr(wordarrays, "_SEGMENT", 1 << 20)
    assert (wordarrays.Texts(texts).key == keys).all()
