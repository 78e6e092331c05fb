"""Catalog text and bit fields against plain Python integers."""

import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.signals import decode_frames, field_layouts, parse_catalog, read_signal_catalog

TEXT = """VERSION ""

NS_ :
	SG_MUL_VAL_

BO_ 900 Tank: 40 Maker
 SG_ Level m7 : 87|10@0+ (0.2,1) [0|200] "l" Maker
 SG_ Page m3M : 23|12@0+ (1,0) [0|0] "no" Maker
 SG_ Book M : 4|6@1+ (1,0) [0|0] "" Maker
 SG_ Heat m9 : 48|9@1- (2,0) [0|0] "K" Maker
 SG_ Part m21M : 104|5@1+ (1,0) [0|0] "" Maker
 SG_ Drip m4 : 112|64@1+ (1,0) [0|0] "" Maker

BO_ 33 Door: 6 Maker
 SG_ Open : 6|2@1+ (1,0) [0|3] "" Maker
 SG_ Angle : 9|17@1+ (0.002,-40) [-40|90] "grad" Maker

CM_ SG_ 33 Open "state";
SG_MUL_VAL_ 900 Level Page 7-7;
SG_MUL_VAL_ 900 Page Book 3-3;
SG_MUL_VAL_ 900 Heat Page 20-29, 40-41;
SG_MUL_VAL_ 900 Part Page 20-29;
SG_MUL_VAL_ 900 Drip Part 4-4;
"""


def test_catalog_files(spark, tmp_path):
    (tmp_path / "can1-a.dbc").write_text(TEXT)
    (tmp_path / "lin2.dbc").write_text(TEXT.replace("\n", "\r\n"))
    (tmp_path / "other.dbc").write_text(TEXT)
    rows = read_signal_catalog(spark, str(tmp_path)).collect()
    assert len(rows) == 16
    assert {r.bus for r in rows} == {"can1", "lin2"}
    by_name = {r.signal: r for r in rows if r.bus == "can1"}
    level = by_name["Level"]
    assert (level.frame_id, level.message, level.start_bit, level.length, level.little_endian) == (900, "Tank", 87, 10, False)
    assert (level.factor, level.offset, level.unit, level.mux, level.mux_signal) == (0.2, 1.0, "l", "m7", "Page")
    assert by_name["Page"].mux_signal == "Book" and by_name["Book"].mux_signal is None
    assert [tuple(x) for x in by_name["Heat"].mux_ranges] == [(20, 29), (40, 41)]
    assert by_name["Angle"].factor == 0.002 and by_name["Open"].message == "Door"


def catalog(spark, text):
    lines = [("can1.dbc", n, line) for n, line in enumerate(text.splitlines())]
    return parse_catalog(spark.createDataFrame(lines, "file string, line_no int, line string"))


def bits_of(payload, start, length, little):
    """The field bit by bit, as the format describes it."""
    if little:
        return sum(((payload[(start + i) // 8] >> ((start + i) % 8)) & 1) << i for i in range(length))
    value, byte, bit = 0, start // 8, start % 8
    for _ in range(length):
        value = value << 1 | (payload[byte] >> bit) & 1
        byte, bit = (byte, bit - 1) if bit else (byte + 1, 7)
    return value


def test_any_field_of_any_frame(spark):
    rng = random.Random(1)
    text, fields = "", {}
    for frame_id, size in ((1, 8), (2, 8), (3, 64), (4, 3)):
        text += f"BO_ {frame_id} M{frame_id}: {size} V\n"
        for n in range(90):
            little, signed, length = rng.random() < 0.5, rng.random() < 0.5, rng.choice([rng.randint(1, 64), 63, 64])
            start = rng.randrange(size * 8)
            text += f" SG_ F{n} : {start}|{length}@{int(little)}{'-' if signed else '+'} (1,0) [0|0] \"\" V\n"
            fields[frame_id, f"F{n}"] = (start, length, little, signed)
    frames = [
        (frame_id, n, bytes(rng.randrange(256) for _ in range(size)))
        for frame_id, size in ((1, 8), (2, 5), (3, 64), (4, 3))
        for n in range(4)
    ]
    df = spark.createDataFrame([(f, n, bytearray(p)) for f, n, p in frames], "frame_id long, n int, payload binary")
    got = {(r.frame_id, r.n, r.signal): r.value for r in decode_frames(df, field_layouts(catalog(spark, text))).collect()}
    expected = {}
    for frame_id, n, payload in frames:
        for (owner, name), (start, length, little, signed) in fields.items():
            if owner != frame_id:
                continue
            try:
                raw = bits_of(payload, start, length, little)
            except IndexError:
                continue
            if signed and raw >> (length - 1):
                raw -= 1 << length
            expected[frame_id, n, name] = float(raw)
    assert got == expected
    assert len(expected) > 300


def placed(size, *fields):
    """A payload with (start, length, little, value) fields set bit by bit."""
    payload = bytearray(size)
    for start, length, little, value in fields:
        byte, bit = start // 8, start % 8
        for i in range(length):
            if value >> (i if little else length - 1 - i) & 1:
                payload[byte] |= 1 << bit
            if little:
                byte, bit = (byte + 1, 0) if bit == 7 else (byte, bit + 1)
            else:
                byte, bit = (byte, bit - 1) if bit else (byte + 1, 7)
    return payload


def test_multiplexed_signals_need_their_selectors(spark):
    def frame(book, page, part=0):
        fields = [(4, 6, True, book), (23, 12, False, page), (87, 10, False, 35), (48, 9, True, 510), (104, 5, True, part)]
        return placed(40, *fields, (112, 64, True, 2**64 - 2048))

    rows = [(1, frame(3, 7)), (2, frame(3, 25)), (3, frame(2, 7)), (4, frame(3, 300)), (5, frame(3, 40, 4)), (6, frame(3, 20, 4)), (7, frame(2, 20, 4))]
    df = spark.createDataFrame([("can1", n, 900, p) for n, p in rows], "bus string, n int, frame_id long, payload binary")
    decoded = decode_frames(df, field_layouts(catalog(spark, TEXT))).collect()
    got = {(r.n, r.signal): r.value for r in decoded if r.signal != "Book"}
    assert got == {
        (1, "Page"): 7, (1, "Level"): 8.0, (2, "Page"): 25, (2, "Heat"): -4.0, (2, "Part"): 0, (4, "Page"): 300,
        (5, "Page"): 40, (5, "Heat"): -4.0, (6, "Page"): 20, (6, "Heat"): -4.0, (6, "Part"): 4, (6, "Drip"): float(2**64 - 2048),
    }
    other_bus = df.withColumn("bus", F.lit("can2"))
    assert decode_frames(other_bus, field_layouts(catalog(spark, TEXT))).count() == 0


def test_impossible_catalogs_are_refused(spark):
    with pytest.raises(ValueError, match="65 bits"):
        field_layouts(catalog(spark, 'BO_ 1 A: 9 V\n SG_ B : 0|65@1+ (1,0) [0|0] "" V\n'))
    text = 'BO_ 1 A: 8 V\n SG_ B m1M : 0|4@1+ (1,0) [0|0] "" V\n SG_ C m1M : 4|4@1+ (1,0) [0|0] "" V\n'
    with pytest.raises(ValueError, match="each other"):
        field_layouts(catalog(spark, text + "SG_MUL_VAL_ 1 B C 1-1;\nSG_MUL_VAL_ 1 C B 1-1;\n"))


def test_devices_use_the_catalogs_of_their_group(spark):
    frames = spark.createDataFrame(
        [(d, 33, placed(6, (6, 2, True, 1))) for d in ("A", "B", "C")], "device string, frame_id long, payload binary"
    )
    groups = spark.createDataFrame([("A", ["can1.dbc"]), ("B", ["can2.dbc"])], "device string, files array<string>")
    layouts = field_layouts(catalog(spark, TEXT))
    got = {r.device for r in decode_frames(frames, layouts, groups).collect()}
    assert got == {"A", "C"}
