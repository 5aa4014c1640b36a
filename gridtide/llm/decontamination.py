"""Benchmark decontamination by templates.

Words are canonicalised: numbers, units after them and names (capitalised words that don't
begin a sentence) become typed placeholders, all else is lower-cased without the punctuation
around it. Windows of canonical words of documents and benchmark items are hash-joined. Windows
of a document that align with an item in one place form a match; its slots must be consistent:
equal values of the item stand against equal values of the document. So a question with other
numbers and names is caught, and a text that only shares the frame is not.

A capitalised word that begins a sentence may be a name or not: its windows are joined in both
readings. And every window is joined as it stands as well, in lower case and with nothing
replaced, so that copies in any case and items of numbers and names alone are found; windows that
are mostly placeholders meet in this form only. An item counts as held if enough of all its
windows match, or if enough consecutive words of it are there as they stand.

A fixed-size table of bits of the benchmark's window hashes lets tasks drop almost all windows
before the join; whatever its load, no match is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

from gridtide.llm.rows import TextRows, unpacked
from gridtide.llm.windows import BYTE_CODES, _gram_hash, mix, range_hash, text_blocks, words_of
from gridtide.staging import stage

WINDOW = 8
MIN_SHARE = 0.5
#: consecutive words of an item, as they stand, that are enough whatever their share
MIN_RUN = 13
BITS = 1 << 22
# fixed values: units that may follow a number
UNITS = frozenset(
    "% percent km m cm mm mi miles mile feet foot ft inches inch in kg g mg lb lbs pounds pound "
    "oz ounces tons l ml liters litres gallons s sec seconds min minutes minute h hours hour days "
    "day weeks week months month years year mph kmh dollars dollar cents cent euros euro usd eur "
    "gbp degrees celsius fahrenheit".split()
)
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
MIXED = re.compile(r"[+-]?[$€£]?\d[\d.,]*[^\W\d_]+")
HELD = "window long, doc long, mark binary, at long, slots array<string>, size int, verbatim boolean"
VERBATIM = np.uint64(1 << 20)


SLOT_CODES = mix(np.array([11, 12, 13], dtype=np.uint64))
WORDY = np.zeros(256, dtype=bool)
WORDY[[*range(48, 58), *range(65, 91), 95, *range(97, 123), 37, *range(128, 256)]] = True
SIGNED = WORDY.copy()
SIGNED[[36, 43, 45]] = True
CLOSING = np.zeros(256, dtype=bool)
CLOSING[list(b"\"')]>")] = True


def _trimmed(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Words without the punctuation around them (a sign or currency may lead)."""
    lead, last = np.flatnonzero(SIGNED[data]), np.flatnonzero(WORDY[data])
    begin = np.append(lead, len(data))[np.searchsorted(lead, start)]
    stop = np.append(-1, last)[np.searchsorted(last, end)] + 1
    begin = np.minimum(begin, end)
    return begin, np.maximum(stop, begin)


def _changed(data, at, low, low_at, live) -> np.ndarray:
    """Whether the letter at each place is another one in the lower-cased text."""
    pad, low_pad = np.append(data, [0, 0]), np.append(low, [0, 0])
    first = pad[at] != low_pad[low_at]
    wide = (pad[at] >= 0xC0) & (pad[at + 1] != low_pad[low_at + 1])
    return live & (first | wide)


def canonical(data: np.ndarray, begins: np.ndarray):
    """Of the texts of a block: codes of all words as they stand and canonical ones, which of them
    are slots, which open a sentence and may be names, the first word of each text (with the end
    as last), and where each word's core lies."""
    whole = data.tobytes()
    lowered = [
        whole[a:b].decode("utf-8", "replace").lower().encode()
        for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())
    ]
    low = np.frombuffer(b"".join(lowered), dtype=np.uint8)
    start, end, first = words_of(data, begins)
    low_start, low_end, _ = words_of(low, np.cumsum([0, *map(len, lowered)]))
    begin, stop = _trimmed(data, start, end)
    low_begin, low_stop = _trimmed(low, low_start, low_end)
    with np.errstate(over="ignore"):
        code = range_hash(BYTE_CODES[low], low_begin, low_stop)

    def inside(flags: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(flags))
        return sums[stop] - sums[begin]

    number = inside((data >= 48) & (data <= 57)) > 0
    for i in np.flatnonzero(number).tolist():
        core = whole[begin[i]: stop[i]].decode("utf-8", "replace")
        number[i] = bool(NUMBER.fullmatch(core) or MIXED.fullmatch(core))
    unit = np.zeros(len(code), dtype=bool)
    for i in (np.flatnonzero(number) + 1).tolist():
        if i < len(code):
            core = low[low_begin[i]: low_stop[i]].tobytes()
            unit[i] = core.decode("utf-8", "replace") in UNITS
    capital = _changed(data, begin, low, low_begin, stop > begin)
    small = inside((data >= 97) & (data <= 122)) > 0
    shout = inside((data >= 65) & (data <= 90)) > 1
    capital &= small | ~shout
    open_end = np.flatnonzero(~CLOSING[data])
    final = np.append(-1, open_end)[np.searchsorted(open_end, end)]
    ends = (final >= start) & np.isin(np.append(data, 0)[final], list(b".?!:"))
    opens = np.append(True, ends)[:-1] if len(ends) else ends
    real = np.diff(first) > 0
    opens[first[:-1][real]] = True
    unit[first[:-1][real]] = False
    capital &= ~number & ~unit
    name = capital & ~opens
    template = np.select([number, unit, name], list(SLOT_CODES), code)
    return code, template, number | unit | name, capital & opens, first, begin, stop


def _windows(sizes: tuple[int, ...], bits, whole_items: bool, window: int):
    """Rows of HELD: of each text the windows of the sizes that pass the bits (None: all).
    Of whole items, those shorter than ``window`` are one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = None if bits is None else bits.value
        for batch, data, begins in text_blocks(batches):
            out: list[list] = [[] for _ in range(7)]
            ids, marks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            code, template, slot, opener, first, begin, stop = canonical(data, begins)
            length = np.diff(first)
            owner = np.repeat(np.arange(len(length)), length)
            named = np.where(opener, SLOT_CODES[2], template)
            slots, openers = np.append(0, np.cumsum(slot)), np.append(0, np.cumsum(opener))
            none = np.zeros(len(code), dtype=bool)
            for size in sizes:
                if len(code) < size:
                    continue
                n = len(code) - size + 1
                inside = owner[:n] == owner[size - 1:]
                if whole_items:
                    inside &= (length[owner[:n]] == size) | (size == window)
                n_slots, n_openers = slots[size:] - slots[:n], openers[size:] - openers[:n]
                wordy = 2 * n_slots <= size  # mostly words, not slots
                # as they stand; as templates; as templates with openers read as names
                forms = (
                    (code, none, inside, VERBATIM),
                    (template, slot, inside & wordy & (n_slots > 0), np.uint64(0)),
                    (named, slot | opener, inside & wordy & (n_openers > 0), np.uint64(0)),
                )
                for codes, at_slots, good, salt in forms:
                    with np.errstate(over="ignore"):
                        hashed = mix(_gram_hash(codes, size) + np.uint64(size) + salt)
                    if mask is not None:
                        good = good & mask[(hashed & np.uint64(BITS - 1)).astype(np.int64)]
                    for i in np.flatnonzero(good).tolist():
                        d = int(owner[i])
                        values_at = [
                            data[begin[k]: stop[k]].tobytes().decode("utf-8", "replace")
                            for k in range(i, i + size) if at_slots[k]
                        ]
                        values = (int(hashed[i].astype(np.int64)), ids[d], marks[d],
                                  i - int(first[d]), values_at, size, bool(salt))
                        for column, value in zip(out, values):
                            column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.int32(),
                     pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(out, kinds)],
                names=["window", "doc", "mark", "at", "slots", "size", "verbatim"],
            )

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", window: int = WINDOW,
    min_share: float = MIN_SHARE, min_run: int = MIN_RUN,
) -> DataFrame:
    """(doc, mark, item_id, n_windows, share, run): documents that hold an item, as it is or with
    other numbers, units and names.

    ``share`` is the part of the item's windows that consistent matches in the document cover;
    ``run`` the longest run of its words that the document holds as they stand (in any case, 0 if
    shorter than a window). Pairs of at least ``min_share`` or ``min_run`` are returned. An item of fewer than ``window`` words is one
    window of them all. Null texts have no words; rows without id (of either table) are left
    out; rows that repeat an id count each by its own text (``mark``, :mod:`rows`), equal rows
    once; tables without rows give none.
    """
    spark = docs.sparkSession
    sizes = tuple(range(window, 0, -1))
    items = stage(
        TextRows(benchmark, item_column, item_text).texts().where("doc is not null")
        .mapInArrow(_windows(sizes, None, True, window), HELD)
        .selectExpr("window", "doc as item_id", "mark as item_mark", "at as item_at",
                    "slots as item_slots", "size", "verbatim").distinct(),
        "item-windows",
    )
    total = items.groupBy("item_id", "item_mark").agg(F.countDistinct("item_at").alias("total"))
    # a bit per window hash, put together in Spark: at most BITS / 8 rows whatever the benchmark
    bit = F.col("window").bitwiseAND(BITS - 1)
    octets = items.groupBy(F.shiftright(bit, 3).alias("octet")).agg(
        F.expr("bit_or(shiftleft(1, cast(window & 7 as int)))").alias("bits")
    ).toPandas()
    packed = np.zeros(BITS // 8, dtype=np.uint8)
    packed[octets["octet"].to_numpy(dtype=np.int64)] = octets["bits"].to_numpy(dtype=np.uint8)
    bits = spark.sparkContext.broadcast(np.unpackbits(packed, bitorder="little").astype(bool))
    sizes = tuple(sorted({r["size"] for r in items.select("size").distinct().collect()}, reverse=True))
    found = (
        TextRows(docs, id_column, text_column).texts().where("doc is not null")
        .mapInArrow(_windows(sizes, bits, False, window), HELD)
    )
    match = stage(
        found.drop("size", "verbatim").join(items, "window").withColumn("shift", F.col("at") - F.col("item_at"))
        .drop("window", "at", "size"),
        "matches",
    )
    place = ["doc", "mark", "item_id", "item_mark", "shift"]
    slot = match.where(F.size("slots") > 0).select(
        *place, F.explode(F.arrays_zip("item_slots", "slots")).alias("pair")
    )
    broken = (
        slot.groupBy(*place, F.col("pair.item_slots").alias("value"))
        .agg(F.min("pair.slots").alias("least"), F.max("pair.slots").alias("most"))
        .where("least != most").select(*place).distinct()
    )
    match = match.drop("slots", "item_slots")
    sound = match.where("verbatim").unionByName(match.where("not verbatim").join(broken, place, "left_anti"))
    whose = ["doc", "mark", "item_id", "item_mark"]
    counted = sound.groupBy(*whose).agg(F.countDistinct("item_at").alias("n_windows"))
    # neighbouring windows of one place: their numbers less their order are equal
    order = W.partitionBy(*place).orderBy("item_at")
    stretch = F.col("item_at") - F.row_number().over(order)
    runs = (
        match.where("verbatim").select(*place, "item_at").distinct()
        .withColumn("stretch", stretch).groupBy(*place, "stretch").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*whose).agg((F.max("n") + (window - 1)).alias("run"))
    )
    share = F.col("n_windows") / F.col("total")
    return (
        counted.join(total, ["item_id", "item_mark"]).join(runs, whose, "left")
        .withColumn("share", share).withColumn("run", F.coalesce("run", F.lit(0)))
        .where((F.col("share") >= min_share) | (F.col("run") >= min_run))
        .groupBy("doc", "mark", "item_id")
        .agg(F.max("n_windows").alias("n_windows"), F.max("share").alias("share"), F.max("run").alias("run"))
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    **options,
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item.

    Of several rows with one id only those whose own text holds one go; null and empty texts and
    rows without id stay; texts of any length are searched whole; without items all rows stay.
    """
    bad = contaminated(docs, benchmark, id_column, text_column, **options)
    bad = bad.select(F.col("doc").alias("bad_doc"), F.col("mark").alias("bad_mark")).distinct()
    rows = TextRows(docs, id_column, text_column).packed()
    same = (F.col("doc") == F.col("bad_doc")) & (F.col("mark") == F.col("bad_mark"))
    return rows.join(bad, same, "left_anti").select(*unpacked("row", docs))
