from __future__ import annotations

import json
import random
import sys
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from plaza.llm import packing, token_files, tokens
from plaza.llm.common import gathered
from plaza.llm.tokens import Encoder, tokenizer_file

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [*" \n\t  ,.;:!?'aBcé ß  12³½\x1c\x85\xa0中文🙂", "<|endoftext|>", "foo", "  ", " the", " it's", "'ll", "%%%", "a.\nB", "‘x’"]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda texts: [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_agrees_with_the_library_on_random_texts(plain):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(60))) for _ in range(4000)]
    found = Encoder(tokenizer_file(PATH))
    assert found.cuts
    assert [x.tolist() for x in found.ids(texts)] == plain(texts)
    assert [x.tolist() for x in found.ids(texts[::-1])] == plain(texts[::-1])  # from the cache


def test_encoder_of_another_kind_encodes_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    found = Encoder(tokenizer_file(path))
    texts = ["Hello  World, it's", "", "a b"]
    assert not found.cuts
    assert [x.tolist() for x in found.ids(texts)] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("most", [50, 10**6])
def test_encoder_agrees_with_the_library_on_marks_and_line_ends(plain, monkeypatch, most):
    monkeypatch.setattr(tokens, "MOST_PIECES", most)
    rng = random.Random(most)
    odd = [*ODD, "\x01", "\x1f", "\r\n", "\n\n", "×÷ª", "—’、", ".'s", "'s.", " .", "word " * 3, "(x)"]
    found = Encoder(tokenizer_file(PATH))
    for _ in range(8):
        rows = ["".join(rng.choice(odd) for _ in range(rng.randrange(30))) for _ in range(500)] + [None, ""]
        assert [x.tolist() for x in found.ids(pa.array(rows))] == plain(rows)
        assert len(found.known) == len(found.coded) == len(found.met) <= most


def test_encoder_without_a_space_in_its_vocabulary():
    kind = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    model = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "vocab": {"a": 0, "b": 1, "ab": 2}, "merges": [["a", "b"]]}
    spec = json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": kind, "post_processor": None, "decoder": None, "model": model})
    rows, found = ["ab a b  ab", " b ab", ""], Encoder(spec)
    assert found.cuts
    assert [x.tolist() for x in found.ids(rows)] == [e.ids for e in Tokenizer.from_str(spec).encode_batch(rows, add_special_tokens=False)]


def test_encoder_calls_no_function_for_each_word(plain):
    """Words that were met before, with punctuation and line ends, cost no Python calls of their own."""
    rng = random.Random(2)
    words = [a + b for a in ("verheitung", "nation", "Xy") for b in (" ", ". ", ",\n", ".\nUnd ")]
    rows, found = ["".join(rng.choices(words, k=200)) for _ in range(200)], Encoder(tokenizer_file(PATH))
    list(found.ids(rows))
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        again = list(found.ids(rows))
    finally:
        sys.setprofile(None)
    assert [x.tolist() for x in again] == plain(rows)
    assert calls < 200 * 200 / 10


def test_batches_put_together():
    batches = [pa.record_batch({"k": [k, -k], "text": ["x" * k, None]}) for k in range(40)]
    found = list(gathered(iter(batches), "text", 100, most=5))
    assert pa.Table.from_batches(found).equals(pa.Table.from_batches(batches).combine_chunks())
    assert [len(b) for b in found[:2]] == [10, 10] and len(found) < 40
    assert all(b.column("text").nbytes < 200 for b in found)
    assert list(gathered(iter([]), "text", 100)) == []


def texts():
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice(["the", "Haus", "ñ", "x1", "\n"]) for _ in range(rng.choice([0, 1, 5, 40, 300])))) for k in range(120)]
    return [*rows, (500, None), (501, ""), (7, "again seven"), (7, "again seven"), (None, "no id"), (502, "long word " * 900)]


def test_packing_places_every_token_once(docs, plain):
    rows = texts()
    found = packing.pack_documents(docs(*rows, extra="piece"), PATH, capacity=128, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    wanted = defaultdict(list)
    for (doc, _), ids in zip(rows, plain([t for _, t in rows]), strict=True):
        wanted[doc].append([*ids, 0])
    for doc, many in wanted.items():
        if len(many) == 1:
            own = sorted(pieces[doc], key=lambda r: r["piece"])
            assert [r["piece"] for r in own] == list(range(len(own)))
            assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in own]).tolist() == many[0]
            assert [r["start"] for r in own] == np.cumsum([0, *[r["length"] for r in own]])[:-1].tolist()
            assert all(r["length"] == 128 for r in own[1:])
        else:
            assert sum(r["length"] for r in pieces[doc]) == sum(map(len, many))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 128
    total = sum(len(x) for many in wanted.values() for x in many)
    assert len(sequences) <= -(-total // 128) + 3


def test_packing_needs_no_sequence_more_than_pieces_over_half(docs):
    """102 full pieces and 30 of more than half a sequence: no two of them fit together, so 132 is the least there is."""
    found = packing.pack_documents(docs(*texts()), PATH, capacity=128).collect()
    over_half = sum(r["length"] > 64 for r in found)
    assert len({r["sequence_id"] for r in found}) == over_half == 132


@pytest.mark.parametrize("seed", range(4))
def test_configurations_place_most_sequences(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(4.5, 1.2, 20_000).astype(int) + 1, 512)
    counts = np.bincount(lengths, minlength=513)
    solved = packing.solve(counts, 512, 250)
    assert all((config * np.arange(513)).sum() in range(510, 513) for _, config in solved)
    assert (sum(times * config for times, config in solved) <= counts).all()
    plan = packing.rounded(counts, solved, 512)
    used = sum(times for times, _ in plan)
    assert sum(times for times, _ in solved) >= 0.95 * used
    assert used <= sum(times for times, _ in packing.best_fit(counts, 512))
    assert used <= -(-int((counts * np.arange(513)).sum()) // 512) + 8


def test_packing_nothing(docs):
    assert packing.pack_documents(docs(), PATH).collect() == []


def test_solver_uses_each_length_as_often_as_there_are_pieces():
    rng = np.random.default_rng(5)
    for size in (0, 1, 30, 3000):
        counts = np.bincount(rng.integers(1, 65, size), minlength=65)
        plan = packing.rounded(counts, packing.solve(counts, 64, 200), 64)
        used = np.zeros(65, int)
        for times, items in plan:
            assert sum(length * many for length, many, _ in items) <= 64
            for length, many, _ in items:
                used[length] += times * many
        assert (used == counts).all()
        assert sum(t for t, _ in plan) <= -(-int((counts * np.arange(65)).sum()) // 64) + 1 + size // 200


def test_configurations_are_kept_by_the_lengths_they_hold():
    """An array of all lengths for each would be 16 KB: 150 MB of the driver's memory for 45,000 documents."""
    lengths = np.minimum(np.random.default_rng(5).lognormal(6.3, 0.9, 4000).astype(int) + 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    tracemalloc.start()
    solved = packing.solve(counts, 2048, 1000)
    packing.rounded(counts, solved, 2048)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(solved) > 1000 and peak < 2000 * len(solved) + 2e6 < 8 * 2049 * len(solved)


def test_best_fill_is_the_best():
    prices = np.zeros(21)
    prices[[3, 7, 11]] = 3.5, 9.0, 14.0
    best = packing.best_fill(prices, 20)
    value = max(3.5 * a + 9 * b + 14 * c for a in range(7) for b in range(3) for c in range(2) if 3 * a + 7 * b + 11 * c <= 20)
    assert best @ prices == value and best @ np.arange(21) <= 20


def test_coder_round_trip_and_checkpoints(monkeypatch):
    monkeypatch.setattr(token_files, "LANES", 8)
    monkeypatch.setattr(token_files, "CHECK", 4)
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 8, 9, 64, 1000):
        ids = np.minimum(rng.geometric(0.01, n) - 1, 999).astype(np.uint32)
        freq = token_files.quantised(np.bincount(ids, minlength=1000), 12)
        coder = token_files.Coder(freq, 12)
        words, states, places = coder.encode(ids)
        assert coder.decode(words, states, places, n).tolist() == ids.tolist()
        for segment in range(len(places)):
            assert coder.decode(words, states, places, n, segment).tolist() == ids[segment * 32 : (segment + 1) * 32].tolist()


@pytest.mark.parametrize("share", [0, 3, 1 << 19])
def test_coder_with_rare_and_sole_ids(share):
    """States at the full scale: one id alone, ids of frequency 1, and ids that fill half of the table."""
    freq = np.array([(1 << 20) - share, *[1] * min(share, 3), *([share - 3] if share > 3 else [])])
    ids = np.random.default_rng(share).integers(0, len(freq), 300_001).astype(np.uint16)
    coder = token_files.Coder(freq)
    words, states, places = coder.encode(ids)
    assert (coder.decode(words, states, places, len(ids)) == ids).all()


def test_quantised_frequencies():
    counts = np.array([0, 1, 1, 10**9, 5])
    freq = token_files.quantised(counts, 8)
    assert freq.sum() == 256 and freq[0] == 0 and (freq[1:] > 0).all()
    with pytest.raises(ValueError):
        token_files.quantised(np.ones(300, int), 8)


@pytest.mark.parametrize("block", [50, 1 << 20])
def test_token_files_round_trip(spark, docs, plain, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK", block)
    rows = texts()
    path = str(tmp_path / "files")
    token_files.write_token_files(docs(*rows, extra="start"), PATH, path)
    found = token_files.read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted([k for k, _ in rows], key=lambda k: (k is not None, k))
    ids = defaultdict(list)
    for (doc, _), own in zip(rows, plain([t for _, t in rows]), strict=True):
        ids[doc].append([*own, 2])
    end = 0
    for r in found:
        assert r["start"] == end and np.frombuffer(r["ids"], "<u4").tolist() in ids[r["doc_id"]]
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["n_tokens"]
        end += r["n_tokens"]


def test_stretches_of_one_block_are_decoded_by_several_tasks(spark, docs, plain, tmp_path):
    path = str(tmp_path / "stretches")
    span = token_files.LANES * token_files.CHECK
    rows = [(1, "one text"), (2, " ".join(f"w{k % 977}" for k in range(span))), (3, "another")]
    token_files.write_token_files(docs(*rows), PATH, path)
    found = token_files.read_segments(spark, path).orderBy("start").collect()
    wanted = [i for own in plain([t for _, t in rows]) for i in [*own, 2]]
    assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in found]).tolist() == wanted
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    longest = max(blocks, key=lambda r: r["n_tokens"])
    assert len(longest["places"]) == -(-longest["n_tokens"] // span) > 1
    assert len({r["task"] for r in found if len(r["ids"]) // 4 > 1000}) > 1
    first, last = span + 40, span + 70
    (few,) = token_files.read_segments(spark, path, first, last).collect()
    own = np.frombuffer(few["ids"], "<u4")[first - few["start"] : last - few["start"]]
    assert own.tolist() == wanted[first:last]


def test_token_files_of_nothing(spark, docs, tmp_path):
    token_files.write_token_files(docs(), PATH, str(tmp_path / "none"))
    assert token_files.read_token_files(spark, str(tmp_path / "none")).collect() == []


def test_damaged_block_is_an_error(spark, docs, tmp_path):
    path = str(tmp_path / "bad")
    token_files.write_token_files(docs((1, "some text here"), (2, "more")), PATH, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    from pyspark.sql import functions as F

    blocks.withColumn("ids_crc32", F.col("ids_crc32") + 1).write.parquet(f"{path}-2/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{path}-2/table")
    with pytest.raises(Exception, match="damaged"):
        token_files.read_token_files(spark, f"{path}-2").collect()
