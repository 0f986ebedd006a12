"""Benchmark decontamination by templates.

Numbers, units and names become typed placeholders, so a question asked again with other numbers or names has the same
template.  Windows of template words are hash-joined with those of the benchmark.  Where enough windows of an item lie
in one stretch of a document, the values that fill its placeholders are compared: they have to be put in consistently, each value of
the item replaced by one value all through, else the likeness is one of form only.  Windows of the raw lower-case words stand
beside them: a copy word for word is found whatever its words are.

Items with the same windows, and the same slots filled alike, cannot be told apart by any document, so they form a class
that is searched and judged once, however many questions a benchmark makes from one template.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelanes.llm.common import text_key
from tradelanes.session import stored

WINDOW = 5  # words
LIKENESS = 0.8  # share of an item's windows that have to line up, and of its slots that have to be consistent
PLAIN = 3  # words of a template window that are no placeholders, at least
RAW = 100  # apart from any size: marks windows of raw words
STRETCH = 2  # an item lies in a stretch of a document of at most so many times its words
FILTER_BITS = 26  # the window filter has at most 2 ** FILTER_BITS bits (8 MB); a benchmark that needs more is joined without it
SPARSE, CLOSE = 64, 8  # bits of the filter for each hash of the benchmark: as it is made, and at least
CHUNK = 1 << 15  # bits in one of Spark's bitmaps

# Words that stand for numbers, and units of measure.
NUMBER_WORDS = set("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
                   "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split())
UNITS = set("mm cm m km g kg mg t l ml s ms min h hz w kw v a kb mb gb tb inch inches foot feet yard yards mile miles ounce ounces "
            "pound pounds gram grams kilogram kilograms meter meters metre metres kilometer kilometers litre litres liter liters "
            "second seconds minute minutes hour hours day days week weeks month months year years degree degrees percent dollar "
            "dollars cent cents euro euros".split())
NUMBER = re.compile(r"[$€£]?[+-]?\d+(?:[.,:/]\d+)*%?$")
NAME = re.compile(r"[^\W\d_a-z]?[^\W\d_]+(?:['’-][^\W\d_]+)*$")
EDGES = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")
SLOTS = {"<number>": "n", "<unit>": "u", "<name>": "p"}
_BASE = 0x9E3779B97F4A7C15  # odd multiplier of the rolling hash


class Words:
    """What is known of each raw word: code as a plain word, whether it may be a number, a unit or a name,
    whether it ends a sentence, and its bare form.  One per task, filled as words are met."""

    def __init__(self):
        self.at: dict[str, int] = {}
        self.codes, self.kinds, self.bare = [], [], []
        self.slot_codes = {s: np.uint64(xxhash.xxh64_intdigest(k.encode())) for k, s in SLOTS.items()}

    def number(self, raw: str) -> int:
        i = self.at.get(raw)
        if i is None:
            i = self.at[raw] = len(self.codes)
            bare = EDGES.sub("", raw)
            low = bare.lower()
            number = bool(NUMBER.match(bare)) or low in NUMBER_WORDS
            name = len(bare) > 1 and bare[0].isupper() and bare[1:].islower() and bool(NAME.match(bare))
            kind = (1 if number else 0) + (2 if low in UNITS else 0) + (4 if name else 0) + (8 if raw.rstrip("\"')]»”").endswith((".", "!", "?", ":")) else 0)
            self.codes.append(xxhash.xxh64_intdigest(low.encode()) if low else 0)
            self.kinds.append(kind + (0 if low else 16))
            self.bare.append(low)
        return i


def templates(texts: list[str | None], words: Words) -> tuple[np.ndarray, ...]:
    """Template words of all texts in a row: text number, code, slot kind ('' for plain words), raw word number and code
    of the raw word.  Bare marks between words are left out."""
    numbers = [[words.number(w) for w in (t or "").split()] for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(n) for n in numbers])
    ids = np.array([i for n in numbers for i in n], np.int64)
    kinds = np.array(words.kinds, np.int64)[ids] if len(ids) else ids
    kept = kinds & 16 == 0
    starts = np.zeros(len(ids), bool)  # first word of a text or after the end of a sentence
    if len(ids):
        starts[0] = True
        starts[1:] = (owner[1:] != owner[:-1]) | (kinds[:-1] & 8 > 0)
    owner, ids, kinds, starts = owner[kept], ids[kept], kinds[kept], starts[kept]
    codes = np.array(words.codes, np.uint64)[ids] if len(ids) else np.zeros(0, np.uint64)
    raw = codes.copy()
    number = kinds & 1 > 0
    unit = np.zeros(len(ids), bool)
    unit[1:] = (kinds[1:] & 2 > 0) & number[:-1] & (owner[1:] == owner[:-1])
    name = (kinds & 4 > 0) & ~starts & ~number & ~unit
    slot = np.full(len(ids), "", "U1")
    for kind, mark in ((number, "n"), (unit, "u"), (name, "p")):
        codes[kind], slot[kind] = words.slot_codes[mark], mark
    return owner, codes, slot, ids, raw


def windows(owner: np.ndarray, codes: np.ndarray, slot: np.ndarray | None, size: int, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of all windows of ``size`` template words within one text that have PLAIN plain words; without
    ``slot`` of raw words, where any will do.  ``first`` has other codes for the first word: only windows that begin with a
    name are told, with that word taken as a plain one."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = np.full(n, size if slot is not None else size + RAW, np.uint64)
    for j in range(size):
        code = first if first is not None and j == 0 else codes
        hashes = (hashes * np.uint64(_BASE)) ^ (code[j: j + n] + (hashes >> np.uint64(29)))
    good = owner[:n] == owner[size - 1:]
    if slot is not None:
        plain = np.concatenate(([0], np.cumsum(slot == "")))
        good &= plain[size:] - plain[:-size] + (first is not None) >= PLAIN
    if first is not None:
        good &= slot[:n] == SLOTS["<name>"]
    at = np.flatnonzero(good)
    return at, hashes[at]


class Filter:
    """Bits set at the leading bits of each wanted hash, eight to a byte."""

    def __init__(self, bits: int, chunks: list[tuple[int, bytes]]):
        self.bits, self.packed = bits, np.zeros(1 << (bits - 3), np.uint8)
        for number, chunk in chunks:
            self.packed[number * CHUNK // 8: (number + 1) * CHUNK // 8] = np.frombuffer(chunk, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def window_filter(windows: DataFrame, most: int = FILTER_BITS) -> Filter | None:
    """Filter of the hashes ``h``, with SPARSE bits for each of these rows as far as 2 ** ``most`` bits go; None where these are not CLOSE for each.
    The bits come to the driver as bitmaps of 4 KB, 2,048 at most."""
    count = windows.count()
    if count * CLOSE > 1 << most:
        return None
    bits = min(most, max(15, (count * SPARSE - 1).bit_length()))
    at = F.shiftrightunsigned(F.col("h"), 64 - bits)
    chunks = windows.groupBy((at / CHUNK).cast("long").alias("number")).agg(F.bitmap_construct_agg(at % CHUNK).alias("chunk"))
    return Filter(bits, [(r.number, bytes(r.chunk)) for r in chunks.collect()])


SCHEMA = "id long, key long, pos int, h long, words int, raw boolean, slots array<string>, class long"
_KIND = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("pos", pa.int32()), ("h", pa.int64()), ("words", pa.int32()), ("raw", pa.bool_()), ("slots", pa.list_(pa.string())), ("class", pa.int64())])


def _as_classes(found: list[tuple]) -> list[tuple]:
    """Windows of items with their slot values numbered in order, and the class of their item: a hash of all this."""
    forms = {}
    for window in found:
        forms.setdefault((window[0], window[4]), []).append(window)
    out = []
    for (_, raw), form in forms.items():
        numbers: dict[str, str] = {}
        form = [(*w[:5], [numbers.setdefault(v, str(len(numbers))) for v in w[5]]) for w in form]
        seal = xxhash.xxh64(str(raw))
        for w in form:
            seal.update(f"{w[1]} {w[2]} {w[3]} {w[5]};")
        out += [(*w, np.uint64(seal.intdigest()).view(np.int64)) for w in form]
    return out


def _windows(sizes: tuple[int, ...], item: bool, wanted=None):
    """Rows (id, key, text) -> windows of template words, with the values of their slots, and of raw words.  Of an ``item``
    with fewer than WINDOW words all of them are one window; under PLAIN words they match texts that have no others.  In
    other texts a name that begins a window may also be a plain word with a capital.  Windows of items have a class and numbers
    for the values of their slots.  ``wanted`` is a filter of hashes."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                if len(words.codes) > 500_000:
                    words = Words()
                owner, codes, slot, ids, raw = templates(part.column(2).to_pylist(), words)
                length = np.bincount(owner, minlength=part.num_rows)
                first = np.concatenate(([0], np.cumsum(length)))
                out = []
                for size in sizes:
                    found = [(False, 0, *windows(owner, codes, slot, size))] if size >= PLAIN else []
                    if size >= PLAIN and not item:
                        found.append((False, 1, *windows(owner, codes, slot, size, raw)))
                    for is_raw, skip, pos, hashes in [*found, (True, 0, *windows(owner, raw, None, size))]:
                        keep = np.ones(len(pos), bool)
                        if size < PLAIN or item and size < WINDOW:
                            keep = length[owner[pos]] == size
                        if wanted is not None:
                            keep &= wanted.value.has(hashes)
                        for p, h in zip(pos[keep].tolist(), hashes[keep].view(np.int64).tolist()):
                            values = [] if is_raw else [f"{slot[i]}:{words.bare[ids[i]]}" for i in range(p + skip, p + size) if slot[i]]
                            out.append((owner[p], p - first[owner[p]], h, length[owner[p]], is_raw, values))
                out = _as_classes(out) if item else [(*o, None) for o in out]
                rows = np.array([o[0] for o in out], np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows)), pa.array([int(o[1]) for o in out], pa.int32()),
                    pa.array([o[2] for o in out], pa.int64()), pa.array([int(o[3]) for o in out], pa.int32()), pa.array([o[4] for o in out], pa.bool_()),
                    pa.array([o[5] for o in out], pa.list_(pa.string())), pa.array([o[6] for o in out], pa.int64())], schema=_KIND)

    return of


def _places(least: float):
    """Rows of one pair of document and class (q, windows, words, item_slots, pos, slots) -> its best place that passes, if any.

    A place is a stretch from a matched window on.  Of the places of a window of the item the one counts that follows
    the window before most closely."""
    def best(table: pa.Table) -> pa.Table:
        order = table.sort_by([("pos", "ascending"), ("q", "ascending")])
        pos, q, item_slots, slots = (order[c].to_pylist() for c in ("pos", "q", "item_slots", "slots"))
        windows, span = order["windows"][0].as_py(), STRETCH * order["words"][0].as_py()
        found, held, end = None, {}, 0  # rows of each window of the item within the stretch
        for start in range(len(pos)):
            while end < len(pos) and pos[end] < pos[start] + span:
                held.setdefault(q[end], deque()).append(end)
                end += 1
            covered = len(held) / windows
            if (start == 0 or pos[start] > pos[start - 1]) and covered >= least and (not found or (covered, 1.0) > found):
                filled, before = {}, None
                for i in sorted(held):
                    row = held[i][0] if before is None else min(held[i], key=lambda r: abs(pos[r] - i - pos[before] + q[before]))
                    for own, value in zip(item_slots[row], slots[row]):
                        filled.setdefault(own, set()).add(value)
                    before = row
                consistent = sum(len(v) == 1 for v in filled.values()) / len(filled) if filled else 1.0
                if consistent >= least:
                    found = max(found or (covered, consistent), (covered, consistent))
            held[q[start]].popleft()
            if not held[q[start]]:
                del held[q[start]]
        row = [[order[c][0].as_py()] for c in ("id", "key", "class")] + [[x] for x in found] if found else [[]] * 5
        return pa.table([pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
                        ["doc_id", "key", "class", "covered", "consistent"])

    return best


def _rows(frame: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return frame.select(F.col(id_col).cast("long").alias("id"), text_key(text).alias("key"), text.alias("text"))


def item_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Windows (id, key, pos, h, words, raw, slots, class) of all items, a table; rows that repeat id and text count once."""
    sizes = tuple(range(1, WINDOW + 1))
    return stored(_rows(benchmark, item_col, text_col).dropDuplicates(["id", "key"]).mapInArrow(_windows(sizes, True), SCHEMA), "item_windows")


def members(windows: DataFrame) -> DataFrame:
    """(class, raw, item_id, item_key) of ``item_windows``: an item is in one class by its template and in one by its raw words,
    as far as it has such windows."""
    return windows.select("class", "raw", F.col("id").alias("item_id"), F.col("key").alias("item_key")).distinct()


def _met(hits: DataFrame, classes: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (id, key, class) -> those whose place in the document passes, with ``covered`` and ``consistent``."""
    of_pair = ["id", "key", "class"]
    wide = pairs.join(classes.select("class", "q", "h", "item_slots", "windows", "words"), "class").withColumnRenamed("id", "__id")
    lined = (wide.join(hits.select("id", "key", "h", "pos", "slots"), ["key", "h"]).where(F.col("__id").eqNullSafe(F.col("id")))
             .select(*of_pair, "q", "windows", "words", "item_slots", "pos", "slots")
             .withColumn("met", F.size(F.collect_set("q").over(Window.partitionBy(*of_pair)))))
    return lined.where(F.col("met") >= least * F.col("windows")).drop("met").groupBy(*of_pair).applyInArrow(
        _places(least), "doc_id long, key long, class long, covered double, consistent double")


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LIKENESS, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows (doc_id, key, item_id, n_items, covered, consistent) of documents that hold benchmark items.

    A row stands for all items that are alike: ``item_id`` is the smallest id among them (null if none has one) and ``n_items`` their number.
    Items are alike by template (the same windows and the same of their slots equal) or by their raw words; ``members`` lists them.
    Where a document holds a template that several items share, no raw copies of these are sought beside it.

    ``covered`` is the share of the item's windows that lie in one stretch of the document, of at most STRETCH times the
    item's words, ``consistent`` the share of its slots that have one value there; both are ``least`` or more, and of all
    places where they are the best counts.  Windows of raw words and of template words are counted apart, and either may do.  An item of fewer than WINDOW words is one window of
    all of them; one under PLAIN words is found only as a whole text.  Items without PLAIN plain words in a window are found by their
    raw words; null or empty texts match nothing, texts of any length are read whole.  A text that occurs
    under several ids counts for each; rows that repeat id and text count once; null ids are kept, of documents and of items.
    Other columns are not read, an empty table on either side gives no rows."""
    spark = docs.sparkSession
    items = item_windows(benchmark, item_col, item_text_col)
    classes = items.dropDuplicates(["class", "pos"]).select("class", "raw", F.col("pos").alias("q"), "h", "words", F.col("slots").alias("item_slots"))
    # An item needs least of its windows, so at least one of its rarest others-plus-one windows is in the document.
    seen = classes.groupBy("h").agg(F.count(F.lit(1)).alias("seen"))
    ranked = stored(classes.join(seen, "h").withColumn("windows", F.count(F.lit(1)).over(Window.partitionBy("class")))
                    .withColumn("nr", F.row_number().over(Window.partitionBy("class").orderBy("seen", "q"))), "item_classes")
    anchors = ranked.where(F.col("nr") <= F.col("windows") - F.ceil(F.col("windows") * least) + 1).select("h", "class", "raw").distinct()
    alike = members(items)
    sized = alike.groupBy("class", "raw").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n_items"),
                                             F.bit_xor(F.xxhash64("item_id", "item_key")).alias("set"))

    used = tuple(r.size for r in ranked.select(F.least("words", F.lit(WINDOW)).alias("size")).distinct().orderBy("size").collect())
    bits = window_filter(ranked.select("h").distinct())
    wanted = spark.sparkContext.broadcast(bits) if bits else None
    windows = _rows(docs, id_col, text_col).mapInArrow(_windows(used, False, wanted), SCHEMA).drop("raw", "words", "class")
    hits = stored(windows.join(ranked.select("h"), "h", "left_semi"), "window_hits")

    met = hits.select("id", "key", "h").distinct()
    by_template = stored(_met(hits, ranked, met.join(anchors.where("not raw"), "h").select("id", "key", "class").distinct(), least), "template_leaks")
    # Raw classes whose items all share one template class: asked for only where the document does not hold that.
    shared = sized.where("not raw and n_items > 1").select(F.col("class").alias("parent"))
    above = (alike.where("not raw").select(F.col("class").alias("parent"), F.col("item_id").alias("__id"), F.col("item_key").alias("__key"))
             .join(shared, "parent"))
    parents = (alike.where("raw").join(above, (F.col("item_key") == F.col("__key")) & F.col("item_id").eqNullSafe(F.col("__id")), "left")
               .groupBy("class").agg(F.min("parent").alias("low"), F.max("parent").alias("high"), F.count("parent").alias("below"), F.count(F.lit(1)).alias("all"))
               .select("class", F.when((F.col("low") == F.col("high")) & (F.col("below") == F.col("all")), F.col("low")).alias("parent")))
    raw = stored(anchors.where("raw").join(parents, "class").select("h", "class", "parent"), "raw_anchors")
    held = by_template.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.col("class").alias("__class"))
    open_pairs = (met.join(raw.select("h", "parent").distinct(), "h")
                  .join(held, (F.col("key") == F.col("__key")) & F.col("id").eqNullSafe(F.col("__id")) & (F.col("parent") == F.col("__class")), "left_anti")
                  .withColumnsRenamed({"h": "__h", "parent": "__parent"}))
    raw_pairs = open_pairs.join(raw, (F.col("h") == F.col("__h")) & F.col("parent").eqNullSafe(F.col("__parent"))).select("id", "key", "class").distinct()
    both = by_template.unionByName(_met(hits, ranked, raw_pairs, least))
    return (both.join(sized, "class").groupBy("doc_id", "key", "set").agg(
        F.max(F.struct("covered", "consistent")).alias("best"), F.min("item_id").alias("item_id"), F.min("n_items").alias("n_items"))
        .select("doc_id", "key", "item_id", "n_items", "best.*"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least: float = LIKENESS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, with all their columns, whose text holds no benchmark item; null and empty texts hold none, rows that
    repeat go or stay together, an empty benchmark or table takes nothing away."""
    found = leaks(docs, benchmark, least, id_col, text_col).select(F.col("doc_id").alias("__leak_id"), F.col("key").alias("__leak_key")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("__id"), text_key(F.coalesce(F.col(text_col), F.lit(""))).alias("__key"))
    same = (F.col("__key") == F.col("__leak_key")) & F.col("__id").eqNullSafe(F.col("__leak_id"))
    return rows.join(found, same, "left_anti").select("row.*")
