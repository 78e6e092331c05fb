"""Signal catalogs and the decoding of frames to physical values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored

# Line formats of the public catalog text format (fixed patterns).
_MESSAGE_LINE = r"^BO_ +(\d+) +(\w+) *: *(\d+)"
_SIGNAL_LINE = (
    r"^\s*SG_ +(\w+) *(m\d+M?|M)? *: *(\d+)\|(\d+)@([01])([+-]) *"
    r"\(([^,]+),([^)]+)\) *\[([^|]*)\|([^\]]*)\] *\"([^\"]*)\""
)
_EXTENDED_MUX_LINE = r"^SG_MUL_VAL_ +(\d+) +(\w+) +(\w+) +([\d\-, ]+);"

#: Lines per block when message headers are handed down to their signals.
_BLOCK_LINES = 5_000


def read_signal_catalog(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Catalog rows of all ``can*`` / ``lin*`` text files below ``path``."""
    # A catalog file is one small text; read whole, it keeps its line order.
    texts = (
        spark.read.option("pathGlobFilter", "{can,lin}*.dbc")
        .text(path, wholetext=True)
        .select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), "value")
    )
    lines = texts.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
    return parse_catalog(lines)


def _headers(kept: DataFrame) -> DataFrame:
    """Every line with the closest message line at or above it in its file.

    Within a block of lines a window finds it; the last header of earlier blocks is carried
    over, so that no file has to be walked through by one task.
    """
    header = F.when(
        F.col("line").rlike(_MESSAGE_LINE),
        F.struct(
            _group(_MESSAGE_LINE, 1).cast("long").alias("frame_id"),
            _group(_MESSAGE_LINE, 2).alias("message"),
            _group(_MESSAGE_LINE, 3).cast("int").alias("size"),
        ),
    )
    rows = kept.withColumn("_own", header).withColumn(
        "_block", F.floor(F.col("line_no") / _BLOCK_LINES).cast("long")
    )
    tails = rows.groupBy("file", "_block").agg(
        F.max_by("_own", F.when(F.col("_own").isNotNull(), F.col("line_no"))).alias("_tail")
    )
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(
        "file", "_block", F.last("_tail", ignorenulls=True).over(earlier).alias("_carried")
    )
    above = (
        Window.partitionBy("file", "_block")
        .orderBy("line_no")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.withColumn("_here", F.last("_own", ignorenulls=True).over(above))
        .join(carry, ["file", "_block"], "left")
        .select("file", "line", F.coalesce("_here", "_carried").alias("_header"))
    )


def _group(pattern: str, n: int) -> Column:
    return F.regexp_extract("line", pattern, n)


def parse_catalog(lines: DataFrame) -> DataFrame:
    """Signal rows from ``file, line_no, line``.

    Multiplexed signals name their selector (``mux_signal``) and the selector values under
    which they are present (``mux_ranges``); extended multiplexing is read from its own lines.
    """
    kept = lines.where(F.col("line").rlike(r"^\s*(BO_|SG_) "))
    signals = (
        _headers(kept)
        .where(F.col("line").rlike(_SIGNAL_LINE))
        .select(
            F.regexp_extract("file", r"^((?:can|lin)\d*)", 1).alias("bus"),
            "file",
            "_header.frame_id",
            "_header.message",
            "_header.size",
            _group(_SIGNAL_LINE, 1).alias("signal"),
            _group(_SIGNAL_LINE, 3).cast("int").alias("start_bit"),
            _group(_SIGNAL_LINE, 4).cast("int").alias("length"),
            (_group(_SIGNAL_LINE, 5) == "1").alias("little_endian"),
            (_group(_SIGNAL_LINE, 6) == "-").alias("signed"),
            _group(_SIGNAL_LINE, 7).cast("double").alias("factor"),
            _group(_SIGNAL_LINE, 8).cast("double").alias("offset"),
            _group(_SIGNAL_LINE, 9).cast("double").alias("min"),
            _group(_SIGNAL_LINE, 10).cast("double").alias("max"),
            _group(_SIGNAL_LINE, 11).alias("unit"),
            F.nullif(_group(_SIGNAL_LINE, 2), F.lit("")).alias("mux"),
        )
    )
    plain = signals.where(F.col("mux") == "M").select(
        "file", "frame_id", F.col("signal").alias("_selector")
    )
    ranges = F.transform(
        F.split(_group(_EXTENDED_MUX_LINE, 4), " *, *"),
        lambda r: F.struct(
            F.split(r, "-")[0].cast("long").alias("lo"), F.split(r, "-")[1].cast("long").alias("hi")
        ),
    )
    extended = lines.where(F.col("line").rlike(_EXTENDED_MUX_LINE)).select(
        "file",
        _group(_EXTENDED_MUX_LINE, 1).cast("long").alias("frame_id"),
        _group(_EXTENDED_MUX_LINE, 2).alias("signal"),
        _group(_EXTENDED_MUX_LINE, 3).alias("_x_selector"),
        ranges.alias("_x_ranges"),
    )
    value = F.nullif(F.regexp_extract("mux", r"^m(\d+)", 1), F.lit("")).cast("long")
    single = F.when(value.isNotNull(), F.array(F.struct(value.alias("lo"), value.alias("hi"))))
    return (
        signals.join(plain, ["file", "frame_id"], "left")
        .join(extended, ["file", "frame_id", "signal"], "left")
        .withColumn("mux_ranges", F.coalesce("_x_ranges", single))
        .withColumn(
            "mux_signal",
            F.when(F.col("mux_ranges").isNotNull(), F.coalesce("_x_selector", "_selector")),
        )
        .select(*signals.columns, "mux_signal", "mux_ranges")
    )


def _layout() -> Column:
    """Where a signal's bits lie, worked out once per catalog row.

    Little-endian fields count bits upwards from the lowest bit of byte 0. Big-endian fields
    name their most significant bit and run to the right, then on to the next byte.
    """
    start, length, little = F.col("start_bit"), F.col("length"), F.col("little_endian")
    byte = F.floor(start / 8)
    # Bits from the top of the first byte to the end of a big-endian field.
    run = F.lit(7) - start % 8 + length
    span = F.when(little, start % 8 + length).otherwise(run)
    all_bits = F.lit(-1).cast("long")
    columns = {
        "little": little,
        "byte": byte.cast("int"),
        "bytes": F.ceil(span / 8).cast("int"),
        # Shift within the bytes touched, and within the whole first word.
        "shift": F.when(little, start % 8).otherwise(F.pmod(-run, F.lit(8))).cast("int"),
        "word_shift": F.when(little, start).otherwise(F.lit(64) - byte * 8 - run).cast("int"),
        "mask": F.call_function("shiftrightunsigned", all_bits, F.lit(64) - length),
    }
    return F.struct(*(c.alias(n) for n, c in columns.items()))


def _with_words(frames: DataFrame) -> DataFrame:
    """The first eight bytes as one number, in both byte orders: once per frame."""
    words = frames.select(
        "*",
        F.octet_length("payload").alias("_size"),
        F.conv(F.rpad(F.hex(F.substring("payload", 1, 8)), 16, "0"), 16, -10).cast("long").alias("_be"),
    ).withColumn("_le", F.col("_be"))
    # Neighbouring bytes change places, then pairs of bytes, then halves.
    for bits in (8, 16, 32):
        x = F.col("_le")
        lower = F.lit(sum(((1 << bits) - 1) << at for at in range(0, 64, 2 * bits))).cast("long")
        down = F.call_function("shiftrightunsigned", x, F.lit(bits)).bitwiseAND(lower)
        words = words.withColumn("_le", down.bitwiseOR(F.call_function("shiftleft", x.bitwiseAND(lower), F.lit(bits))))
    return words


def _long_field(field: Column) -> Column:
    """A field that lies behind the first eight bytes, from the text of the bytes it touches."""
    digits = F.hex(F.substring(F.col("payload"), field["byte"] + 1, field["bytes"]))
    # Little-endian: turn the byte pairs round, so that the first byte comes last.
    pairs = F.regexp_extract_all(digits, F.lit("(..)"), F.lit(1))
    number = F.when(field["little"], F.array_join(F.reverse(pairs), "")).otherwise(digits)
    # A field can touch nine bytes. The lower seven and the upper two are converted apart and
    # put together after the shift, so that everything stays within a long.
    padded = F.lpad(number, 18, "0")
    low = F.conv(F.substring(padded, 5, 14), 16, 10).cast("long")
    high = F.conv(F.substring(padded, 1, 4), 16, 10).cast("long")
    shift = field["shift"]
    return F.call_function("shiftright", low, shift).bitwiseOR(
        F.call_function("shiftleft", high, F.lit(56) - shift)
    )


def _raw(field: Column) -> Column:
    """The 64-bit pattern of a field's raw value, null if the payload is too short."""
    end = field["byte"] + field["bytes"]
    word = F.when(field["little"], F.col("_le")).otherwise(F.col("_be"))
    bits = F.when(
        end <= 8, F.call_function("shiftrightunsigned", word, field["word_shift"])
    ).otherwise(_long_field(field))
    return F.when(F.col("_size") >= end, bits.bitwiseAND(field["mask"]))


def _number(raw: Column, length: Column, signed: Column) -> Column:
    """The raw value as a double, rounded once.

    Shifting up and back spreads the sign bit. An unsigned pattern is put together from its
    upper 53 and lower 11 bits, both exact, since half of the 64-bit ones would be negative.
    """
    unused = (F.lit(64) - length).cast("int")
    spread = F.call_function("shiftright", F.call_function("shiftleft", raw, unused), unused)
    upper = F.call_function("shiftrightunsigned", raw, F.lit(11)).cast("double")
    whole = upper * 2048.0 + raw.bitwiseAND(F.lit(2047).cast("long")).cast("double")
    return F.when(signed, spread.cast("double")).otherwise(whole)


def _selected(selectors: Column) -> Column:
    """Each selector up to the top has a value in this frame that lies in one of its ranges."""

    def fits(selector: Column) -> Column:
        value = _raw(selector["field"])
        return F.coalesce(F.exists(selector["ranges"], lambda r: value.between(r["lo"], r["hi"])), F.lit(False))

    return (F.size(selectors) == 0) | F.forall(selectors, fits)


def _with_selectors(fields: Column) -> Column:
    """Each field of a frame with the layouts and ranges of its selectors up to the top, and in ``above`` the
    selector that is still open when as many levels are passed as the frame has selectors."""
    levels = F.size(F.array_distinct(F.filter(fields["above"], lambda name: name.isNotNull())))

    def selector(field: Column, ranges: Column) -> Column:
        return F.struct(field.alias("field"), ranges.alias("ranges"))

    def state(above: Column, ranges: Column, selectors: Column) -> Column:
        return F.struct(above.alias("above"), ranges.alias("ranges"), selectors.alias("selectors"))

    def climb(passed: Column, _: Column) -> Column:
        over = F.get(F.filter(fields, lambda f: f["signal"] == passed["above"]), F.lit(0))
        longer = F.concat(passed["selectors"], F.array(selector(over["layout"], passed["ranges"])))
        return F.when(passed["above"].isNull(), passed).otherwise(state(over["above"], over["ranges"], longer))

    def resolved(f: Column) -> Column:
        none = F.filter(F.array(selector(f["layout"], f["ranges"])), lambda _: F.lit(False))
        top = F.aggregate(F.sequence(F.lit(0), levels), state(f["above"], f["ranges"], none), climb)
        kept = ("message", "signal", "unit", "signed", "factor", "offset", "length", "layout")
        return F.struct(*(f[c].alias(c) for c in kept), top["selectors"].alias("selectors"), top["above"].alias("above"))

    return F.transform(fields, resolved)


def field_layouts(catalog: DataFrame) -> DataFrame:
    """``bus, file, frame_id, fields``: all that decoding needs to know of a frame's signals, stored once.

    A selector may itself be multiplexed, to any depth: each signal carries the layouts of all its selectors
    up to the top. The table has one row per frame id of a catalog file, made by one aggregate, and is as small as the
    catalog; stored, Spark knows so and broadcasts it by its own size check.
    """
    field = F.struct(
        "message", "signal", "unit", "signed", "factor", "offset", "length",
        _layout().alias("layout"), F.col("mux_signal").alias("above"), F.col("mux_ranges").alias("ranges"),
    )
    frames = catalog.groupBy("bus", "file", "frame_id").agg(F.collect_list(field).alias("fields"))
    layouts = stored(frames.withColumn("fields", _with_selectors(F.col("fields"))), "field-layouts")
    wrong = layouts.select("file", F.explode("fields").alias("f")).select("file", "f.signal", "f.length", "f.above")
    wide = ~F.col("length").between(1, 64)
    for row in wrong.where(wide | F.col("above").isNotNull()).orderBy(~wide).take(1):
        if not 1 <= row.length <= 64:
            raise ValueError(f"signal {row.signal} of {row.file} has {row.length} bits; 1 to 64 can be decoded")
        raise ValueError("selectors of a catalog select each other")
    return layouts


def decode_frames(
    frames: DataFrame, layouts: DataFrame, groups: DataFrame | None = None
) -> DataFrame:
    """Long physical values ``..., message, signal, value, unit`` from frames.

    Frames have ``frame_id`` and a binary ``payload``, and optionally the ``bus`` they were
    seen on; ``layouts`` come from ``field_layouts`` and meet each frame once, with all of its signals. A multiplexed
    signal appears only in frames that carry its selector value. Fields that reach beyond the payload are left out.
    Layouts too large to broadcast are joined by shuffle, with AQE splitting hot frame ids.

    ``groups`` (see ``sources.configs.catalog_groups``) limits each listed ``device`` to its
    catalog files; devices in no group use all of them.
    """
    on = ["bus", "frame_id"] if "bus" in frames.columns else ["frame_id"]
    wanted = layouts if "bus" in on else layouts.drop("bus")
    words = _with_words(frames)
    allowed = F.lit(True)
    if groups is not None:
        words = words.join(stored(groups.select("device", F.col("files").alias("_files")), "groups"), "device", "left")
        allowed = F.col("_files").isNull() | F.array_contains("_files", F.col("file"))
    field = F.col("_f")
    kept = [c for c in frames.columns if c != "payload"]
    return (
        words.join(wanted.select(*on, "file", F.col("fields").alias("_fields")), on)
        .where(allowed)
        .select(*kept, "payload", "_size", "_be", "_le", F.explode("_fields").alias("_f"))
        .where(_selected(field["selectors"]))
        .withColumn("_value", _raw(field["layout"]))
        .where(F.col("_value").isNotNull())
        .select(
            *kept,
            "_f.message",
            "_f.signal",
            (_number(F.col("_value"), field["length"], field["signed"]) * field["factor"] + field["offset"]).alias("value"),
            "_f.unit",
        )
    )
