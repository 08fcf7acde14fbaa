"""Benchmark decontamination with one Aho-Corasick automaton over word windows.

Every window of ten consecutive words of a benchmark item (the whole item, if it has
fewer) is a pattern. Words of the benchmark become characters (one each, or two each
for over ``ONE_CHARACTER`` different words), so a pattern has ten of them, a document
becomes one code per word, and the automaton's positions give word positions. One scan finds all windows of all items; word
positions map back to offsets in the original text.

The automaton is broadcast. It holds at most ``SLICE_WINDOWS`` windows, a proven
bound; a larger benchmark is cut into slices of windows, scanned one after another,
and the findings of a document are united. No window is left out.

Defined cases: an absent or empty text has no words and no hits; an item without
words has no window; items that share a window are all reported; repeated items
count once; an absent item id is the text ``null``; an empty benchmark hits nothing;
other columns, whatever their names, stay as they are in ``row``.
"""

import itertools
import math
import re
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import map_batches
from beatgrid.sources.staging import materialise

WINDOW = 10
SLICE_WINDOWS = 200_000
UNKNOWN = "\0"
#: So many words have a character each; beyond, each has one of 0x4000 characters and one of the others, so that codes never match across words.
ONE_CHARACTER = 1_000_000
LEADING, SURROGATES_END = 0x4000, 0xE000
#: Fixed: ASCII letters and digits and all other characters from U+0080 on are word characters.
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOUND = "row {row}, n_words long, spans array<struct<first:int,last:int>>, offsets array<struct<start:int,stop:int>>, items array<string>"


def word_table() -> bytes:
    """Lower-cases A-Z and turns every other ASCII byte that is no digit or letter into a space."""
    return bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def windows_of(words: list[bytes], size: int) -> Iterable[bytes]:
    return (b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else ()


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW, text: str = "text", item: str = "item_id") -> DataFrame:
    """Distinct pairs of a window and an item that has it."""
    def work(batches):
        clean = word_table()
        for batch in batches:
            pairs = [(window, name) for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                     for window in windows_of((value or "").encode().translate(clean).split(), size)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()),
                                              pa.array([p[1] for p in pairs], pa.string())], names=["window", "item"])

    named = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    return map_batches(named, work, "window binary, item string").distinct()


def code_of(number: int, width: int) -> str:
    """The characters of the word with this number; code points of UTF-16 surrogates are no characters."""
    if width == 1:
        point = number + 1
        return chr(point + 0x800 if point >= 0xD800 else point)
    return chr(1 + number % LEADING) + chr(SURROGATES_END + number // LEADING)


def build_automaton(pairs: Iterable[tuple[bytes, str]], one_character: int = ONE_CHARACTER) -> tuple[dict[bytes, str], ahocorasick.Automaton | None, int]:
    """Codes of words, the automaton over windows written in them, and the characters a code has."""
    items: dict[bytes, list[str]] = {}
    for window, item in pairs:
        items.setdefault(bytes(window), []).append(item)
    numbers: dict[bytes, int] = {}
    for window in items:
        for word in window.split(b" "):
            numbers.setdefault(word, len(numbers))
    width = 1 if len(numbers) <= one_character else 2
    codes = {word: code_of(number, width) for word, number in numbers.items()}
    if not items:
        return codes, None, width
    automaton = ahocorasick.Automaton()
    for window, names in items.items():
        words = window.split(b" ")
        automaton.add_word("".join(map(codes.__getitem__, words)), (len(words), tuple(names)))
    automaton.make_automaton()
    return codes, automaton, width


def united(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Inclusive spans, merged where they overlap."""
    merged: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return merged


def find(coded: str, automaton, width: int = 1) -> tuple[list[tuple[int, int]], set[str]]:
    spans, names = [], set()
    for end, (length, items) in automaton.iter(coded):
        last = end // width
        spans.append((last - length + 1, last))
        names.update(items)
    return united(spans), names


def original_offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the text of spans of words."""
    if not spans:
        return []
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    at = [m.span() for m in WORDS.finditer(lowered)]
    return [(at[first][0], at[last][1]) for first, last in spans]


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW,
         slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """Each row packed in ``row``, its word count, hit spans in words and characters, and the items found."""
    spark = docs.sparkSession
    pairs = materialise(benchmark_windows(benchmark, size), "windows")
    slices = max(1, math.ceil(pairs.count() / slice_windows))
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = FOUND.format(row=found.schema["row"].dataType.simpleString())
    for i in range(slices):
        part = pairs.filter(F.pmod(F.xxhash64("window"), F.lit(slices)) == i).collect()
        shared = spark.sparkContext.broadcast(build_automaton((r["window"], r["item"]) for r in part))
        found = map_batches(found, _scanner(shared, text), schema)
        if i + 1 < slices:
            found = materialise(found, "scanned")
    return found


def _scanner(shared, text: str):
    def work(batches):
        clean, (codes, automaton, width) = word_table(), shared.value
        unknown = UNKNOWN * width
        for batch in batches:
            row = batch.column(0)
            values = row.field(row.type.get_field_index(text)).to_pylist()
            earlier = batch.num_columns > 1
            before = batch.column(2).to_pylist() if earlier else itertools.repeat(None)
            named = batch.column(4).to_pylist() if earlier else itertools.repeat(None)
            counts, spans, offsets, items = [], [], [], []
            for value, old, old_items in zip(values, before, named):
                words = (value or "").encode().translate(clean).split()
                counts.append(len(words))
                coded = "".join(map(codes.get, words, itertools.repeat(unknown)))
                hit, names = find(coded, automaton, width) if automaton is not None and words else ([], set())
                if old:
                    hit, names = united([*hit, *((s["first"], s["last"]) for s in old)]), names | set(old_items)
                spans.append([{"first": a, "last": b} for a, b in hit])
                offsets.append([{"start": a, "stop": b} for a, b in original_offsets(value, hit)] if hit else [])
                items.append(sorted(names))
            span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            offset = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(offsets, offset), pa.array(items, pa.list_(pa.string()))],
                names=["row", "n_words", "spans", "offsets", "items"])
    return work


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window occurs."""
    return scan(docs, benchmark).filter(F.size("spans") == 0).select("row.*")


def op5_benchmark_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hit words and items of every document."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return scan(docs, benchmark).select(
        "row.doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
