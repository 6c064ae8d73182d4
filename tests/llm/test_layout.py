"""Packing, sharding and media files: round trips, exact layouts, corrupt input."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import empty, frame, odd_documents
from pyspark.sql import functions as F

from placeforge.llm import hilbert, media, packing


def test_packing_is_gapless_and_reads_back(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    extra = ("en", "s", 1, "x", 7, "y", 9, "z", "b")
    odd = ["<|endoftext|> a", "a<|endoftext|>b  <|endoftext|>", " <|endoftext|>\n", "a  b   c \t d\n\n e", "x\u00a0y z\u2003w \u200b v\x85 u\u180e t", "it's we'll 'd x'", "日本 語 한국 \U0001f600 \U0001f600é", "é à É", "n" * 200_000, " ".join(map(str, range(9000)))]
    rows = [*odd_documents(), *[(110 + k, t, *extra) for k, t in enumerate(odd)], (105, "<|endoftext|> it's naïve  1234   \n\n", "en", "s", 1, "x", 7, "y", 9, "z", "b")]
    packed = packing.pack(frame(spark, rows), keep_ids=True)
    found = packed.collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length <= packing.MAX_TOKENS
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.MAX_TOKENS
    assert len(by_sequence) <= -(-sum(r.length for r in found) // packing.MAX_TOKENS) + 1
    for doc_id, text, *_ in rows:
        if doc_id in (None, 102):
            continue
        parts = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [i for r in parts for i in r.ids] == [*exact.encode(text or "", add_special_tokens=False).ids, 0]
        assert [r.start for r in parts] == list(np.cumsum([0, *(r.length for r in parts)])[:-1]) and all(r.length == packing.MAX_TOKENS for r in parts[1:])
    assert len(by_doc[102]) == 2
    assert sorted(len(r.ids) for r in packing.sequences(packed).collect()) == sorted(sum(n for _, n in p) for p in by_sequence.values())
    assert packing.pack(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_planned_best_fit_places_every_piece_once(seed):
    r = np.random.default_rng(seed)
    lengths = r.integers(1, [64, 10, 33, 64][seed % 4] + 1, 3000)
    histogram = dict(zip(*map(np.ndarray.tolist, np.unique(lengths, return_counts=True)), strict=True))
    used = defaultdict(list)
    for length, rank, pieces, first, offset in packing.best_fit(histogram, 64):
        for k in range(pieces):
            used[first + k].append((offset, length))
    assert sum(map(len, used.values())) == 3000 and sorted(used) == list(range(len(used)))
    for parts in used.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0, *(n for _, n in parts)])[:-1]) and sum(parts[-1]) <= 64
    assert len(used) <= -(-lengths.sum() // 64) * 1.23 + 1


def test_hilbert_curve_visits_every_cell_by_single_steps():
    for bits, dims in ((4, 2), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = hilbert.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_shards_are_even_gapless_runs_of_the_curve(spark):
    rows = odd_documents(300)
    found = hilbert.shard(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found if r.doc_id is not None) == sorted((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows if d is not None)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in found:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in found)
    assert max(sizes.values()) - min(sizes[k] for k in sizes) <= 2 * largest
    order = sorted(found, key=lambda r: (r.shard, r.slot))
    assert [r.cell for r in order] == sorted(r.cell for r in order)
    assert hilbert.shard(empty(spark)).count() == 0


def test_shards_match_a_plain_cut_of_the_order(spark):
    rows = odd_documents(300)
    found = sorted(hilbert.shard(frame(spark, rows)).collect(), key=lambda r: (r.shard, r.slot))
    total, end = sum(r.size for r in found), 0
    for r in found:  # a row goes where the middle of its bytes lies
        end += r.size
        assert r.shard == min(15, (2 * end - r.size) * 16 // (2 * total))
    order = {}
    for doc_id, text, lang, source, *_ in rows:
        size = len((text or "").encode()) + 1
        order.setdefault((source, lang, size), set()).add((doc_id, size, zlib.crc32((text or "").encode())))
    cells = defaultdict(set)
    for r in found:
        cells[r.cell].add((r.doc_id, r.size, r.text_crc32))
    for one in order.values():  # rows alike in every dimension lie in one cell
        assert any(one <= c for c in cells.values())


def test_shards_prune_by_the_least_and_greatest_value_of_each_column(spark):
    """A reader of one source, one language or one size skips the shards whose range it is not in."""
    rows = [(k, "x" * (40 + k % 7 * 3), f"l{k % 5}", f"s{k % 9}", 1, "x", 7, "y", 9, "z", "b") for k in range(3150)]
    shards = defaultdict(list)
    for r in hilbert.shard(frame(spark, rows)).collect():
        shards[r.shard].append((rows[r.doc_id][3], rows[r.doc_id][2], r.size))
    for column, most in ((0, 0.5), (1, 0.65), (2, 0.65)):
        ranges = [(min(x[column] for x in s), max(x[column] for x in s)) for s in shards.values()]
        values = {x[column] for s in shards.values() for x in s}
        assert sum(low <= v <= high for v in values for low, high in ranges) < most * len(values) * 16


def test_codes_keep_the_order_of_a_column(spark):
    of = lambda values, levels=4: hilbert.cuts_of([(v, 1) for v in values], levels)
    assert of([]) == [] and of(["b", "a", "b"]) == ["b"] and of(range(8)) == [1, 3, 5] and of(["hot", *"abcdefghij"]) == ["c", "f", "hot"]
    assert of(["hot"] * 90 + list("abcdefghij")) == ["hot"] and hilbert.cuts_of([(k, 1 if k < 8 else 100) for k in range(10)], 2) == [8]
    r = random.Random(1)
    values = [None, *(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200))]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    cuts = of([v for v in values if v], 16)
    got = sorted(((x.v or "", x.c) for x in df.withColumn("c", hilbert.code(df["v"], cuts, "string")).collect()))
    assert [c for _, c in got] == sorted(c for _, c in got) and got[0][1] == 0 and got[-1][1] == len(cuts) * 16 // (len(cuts) + 1)


def test_written_shards_hold_all_rows(spark, tmp_path):
    rows = odd_documents()
    hilbert.write_shards(frame(spark, rows), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s")).collect()
    columns = ("doc_id", "text", "lang", "source", "n_chars", "_words", "kept", "copy", "row", "bucket")
    spots = [frame(spark, rows[:1]).columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in back), key=repr) == sorted((tuple(r[k] for k in spots) for r in rows), key=repr)
    hilbert.write_shards(empty(spark), str(tmp_path / "e"))


def test_media_round_trip(spark):
    rows = odd_documents()
    for r, (doc_id, text, *_) in zip(media.media_table(frame(spark, rows)).collect(), rows, strict=True):
        raw = (text or "").encode()
        payload = raw + b"\xff" * (576 if not raw else -len(raw) % 576)
        assert (r.doc_id, r.n_bytes, r.payload_bytes, r.error) == (doc_id, len(raw), len(payload), None)
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-32:])
        file = media.write_media(payload)
        assert (r.media_bytes, r.media_sha256) == (len(file), hashlib.sha256(file).hexdigest())
        assert [file[k.offset : k.offset + k.length] for k in r.keyframes] == [payload[a : a + 576] for a in range(0, len(payload), 576 * media.SYNC)]
        assert r.duration_s == len(payload) / media.RATE and r.codec == "raw"
    assert media.media_table(empty(spark)).count() == 0


def test_media_reads_other_layouts_and_refuses_broken_ones():
    payload = bytes(range(256)) * 18
    file = media.write_media(payload)
    moov = file.index(b"moov") - 4
    mdat = file.index(b"mdat") - 4
    wide = file[:moov] + media.box(b"free", b"x" * 5) + file[moov:mdat] + (1).to_bytes(4, "big") + b"mdat" + (len(payload) + 16).to_bytes(8, "big") + payload
    shifted = bytearray(wide)
    at = shifted.index(b"stco") + 12
    shifted[at : at + 4] = (int.from_bytes(shifted[at : at + 4], "big") + 13 + 8).to_bytes(4, "big")
    assert media.payload_of(bytes(shifted), media.read_media(bytes(shifted))["ranges"]) == payload
    for broken in (b"", b"abc", file[:-1], file[:100], file.replace(b"stsz", b"stsy"), file.replace(b"\x00\x00\x02\x40\x00\x00\x00\x08", b"\x00\x00\x02\x40\x00\x00\x00\x09")):
        assert media.probe_one(broken)["error"]
    assert media.probe_one(None) is None


def test_media_tracks_are_read_each_by_its_own_tables():
    payload = bytes(range(256)) * 45
    file = media.write_media(payload)
    view = memoryview(file)
    moov = media.inside(view, (0, len(file)), b"moov")
    trak = next((a, b) for k, a, b in media.boxes(view, *moov) if k == b"trak")
    other = bytes(file[trak[0] - 8 : trak[1]])
    without = bytearray(other)
    without[without.index(b"stss") : without.index(b"stss") + 4] = b"skip"
    ftyp, body = file[: moov[0] - 8], bytes(file[moov[0] : trak[0] - 8])
    added = len(other)
    for first, second in ((bytes(without), other), (other, bytes(without))):
        both = bytearray(ftyp + media.box(b"moov", body, first, second) + file[moov[1] :])
        at = -1
        while (at := both.find(b"stco", at + 1)) >= 0:
            for k in range(int.from_bytes(both[at + 8 : at + 12], "big")):
                spot = at + 12 + 4 * k
                both[spot : spot + 4] = (int.from_bytes(both[spot : spot + 4], "big") + added).to_bytes(4, "big")
        found = media.probe_one(bytes(both))
        keys = [len(found["keyframes"]), len(found["more_tracks"][0]["keyframes"])]
        assert keys == ([20, 3] if first == bytes(without) else [3, 20]) and found["error"] is None
        assert found["payload_sha256"] == hashlib.sha256(payload).hexdigest()


def test_media_of_hostile_files_are_errors():
    file = media.write_media(bytes(range(256)) * 18)

    def changed(kind, at, value):
        out = bytearray(file)
        spot = out.index(kind) + 4 + at
        out[spot : spot + len(value)] = value
        return bytes(out)

    top = b"\xff\xff\xff\xff"
    deep = b""
    for _ in range(3000):
        deep = media.box(b"moov", deep)
    hostile = [changed(b"mdhd", 12, bytes(4)), deep, changed(b"stsz", 8, top), changed(b"stsz", 4, bytes(4)), changed(b"stsz", 4, top), changed(b"stts", 8, top), changed(b"stts", 12, top), changed(b"stsc", 12, top), changed(b"stsc", 8, bytes(4)), changed(b"stco", 8, top), changed(b"stco", 4, top), changed(b"stss", 8, bytes(4)), changed(b"stss", 8, top), changed(b"mdhd", 0, b"\x01"), changed(b"trak", -4, b"xxxx")]
    for data in hostile:
        found = media.probe_one(data)
        assert found["error"] and found["media_bytes"] == len(data) and found.get("codec") is None
    for cut in range(0, len(file), 7):
        assert media.probe_one(file[:cut])["error"]


def test_media_columns_beside_nulls_and_clashing_names(spark):
    good = media.write_media(media.padded(b"some text"))
    rows = spark.createDataFrame([(1, good, "x"), (2, None, "y"), (3, b"no file", "z"), (4, good, None)], "id long, media binary, probe string")
    found = {r.id: r.probe for r in media.probe(rows).collect()}
    assert found[2] is None and found[3].error and found[1] == found[4] and found[1].payload_bytes == 576
    assert media.encode(rows.select("id", F.col("probe").alias("text"), F.lit(1).alias("MEDIA"))).columns == ["id", "text", "media"]


def test_equal_pieces_are_dealt_to_salts(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_A_SALT", 7)
    rows = [(1, "one two three", "en", "s", 1, "x", 7, "y", 9, "z", "b")] * 60
    packed = packing.pack(frame(spark, rows), most=16).collect()
    assert len(packed) == 60 and len({(r.sequence_id, r.offset) for r in packed}) == 60
    assert len({r.sequence_id for r in packed}) == 60 * packed[0].length // (16 // packed[0].length * packed[0].length) + (60 % (16 // packed[0].length) > 0)


def test_cuts_are_those_of_all_rows(spark):
    """Far more rows than a sample would hold: the cuts are those of a plain sort of them all, to the value."""
    r = random.Random(8)
    values = [None, *range(12_000)]
    rows = [(r.choice(values), r.randint(1, 9)) for _ in range(21_000)] + [(k, 1_000) for k in range(9)]
    df = spark.createDataFrame(rows, "v long, size long").repartition(5)
    known = [(v, n) for v, n in rows if v is not None]
    assert hilbert.all_cuts(df, "v", 16) == hilbert.cuts_of(known, 16)
    assert hilbert.all_cuts(df.where("v < 9"), "v", 16) == list(range(1, 9)) and hilbert.all_cuts(df.limit(0), "v", 16) == []
