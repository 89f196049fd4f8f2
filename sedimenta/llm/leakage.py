"""Evaluation texts leaking into training text: template windows and slot checks.

Every word is canonicalised to a template token: numbers, names and units give
typed placeholders, plain words stand for themselves. What a word is follows
from its shape and from how the corpus uses it (how often with a capital, how
often after a number), and is the same however a passage is cased, wrapped or
marked up; a word that no item has can only fill a slot. Windows of template
tokens are hashed and joined, and what their slots hold decides: equal values
are a verbatim leak; values that differ, but map one-to-one over an aligned run,
are a re-parameterised question.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Scratch
from . import kernel as K

U64 = np.uint64
WORD = re.compile(r"[^\W_]+")
# what stands before is looked at only behind a first character that fits, not at every place of a text
_COUNTED = re.compile(r"\d(?<![^\W_].)\d*[\W_]+([^\W\d_]+)(?![^\W_])")
_INSIDE = re.compile(r"[A-ZÀ-Þ](?<=[^\W_] .)[^\W_]*")
#: A word is a name if so much of its use has a capital, a unit if so much of it follows a number.
NAME_SHARE, UNIT_SHARE = 0.8, 0.5
#: Words and statements are worked off in stretches of so many words.
STRETCH = 200_000
_NUMBER, _NAME, _UNIT = (xxhash.xxh3_64_intdigest(f"\u0001{kind}") for kind in ("number", "name", "unit"))


class Bits:
    """A set of hashes as a bit array of fixed size: what is in it is seen, little else is; its size does not follow the data."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, U64(64 * len(words) - 1)

    @classmethod
    def of(cls, hashes: DataFrame, log2: int) -> Bits:
        """The bits of a one-column table of hashes; the driver receives at most 2**(log2 - 6) words."""
        at = F.col(hashes.columns[0]).bitwiseAND(F.lit((1 << log2) - 1).cast("bigint"))
        rows = hashes.groupBy(F.shiftright(at, 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
        words = np.zeros(1 << (log2 - 6), U64)
        for r in rows.collect():
            words[r["w"]] = np.int64(r["bits"]).view(U64)
        return cls(words)

    def __contains__(self, h: int) -> bool:
        at = h & int(self.mask)
        return bool(int(self.words[at >> 6]) >> (at & 63) & 1)

    def holds(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.words[at >> U64(6)] >> (at & U64(63))) & U64(1) == 1


class Lexicon(dict):
    """Word in any case -> number of its entry in ``template``, ``exact`` and ``slot``; filled as words come up."""

    def __init__(self, plain: Bits, units: Bits, most: int = 200_000):
        super().__init__()
        self.plain, self.units, self.most = plain, units, most
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.template: list[int] = []
        self.exact: list[int] = []
        self.slot: list[bool] = []

    def __missing__(self, word: str) -> int:
        low = word.lower()
        exact = xxhash.xxh3_64_intdigest(low)
        if low.isdigit():
            kind = _NUMBER
        elif exact in self.units:
            kind = _UNIT
        else:
            kind = exact if exact in self.plain else _NAME
        self[word] = len(self.exact)
        self.template.append(kind)
        self.exact.append(exact)
        self.slot.append(kind != exact)
        return self[word]


def _stretches(batch: pa.RecordBatch, overlap: int) -> Iterator[tuple[list, list[int], list[list[str]], int]]:
    """Texts of (id, text) as (ids, first positions, words, their number), about STRETCH words at once; a longer text in parts of its own that share ``overlap`` words."""
    ids, at, words, total = [], [], [], 0
    for rid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        text = text.as_py()
        if len(text) <= 4 * STRETCH:
            ids.append(rid)
            at.append(0)
            words.append(WORD.findall(text))
            total += len(words[-1])
            if total >= STRETCH:
                yield ids, at, words, total
                ids, at, words, total = [], [], [], 0
            continue
        found = (m.group() for m in WORD.finditer(text))
        part, pos = list(islice(found, STRETCH)), 0
        while part:
            yield [rid], [pos], [part], len(part)
            more = list(islice(found, STRETCH))
            keep = part[-overlap:] if more else []
            pos += len(part) - len(keep)
            part = keep + more if more else []
    if ids:
        yield ids, at, words, total


def _uses(items: Bits):
    """mapInArrow over (id, text): per batch and word of the items, its uses in lower case, as a name (capitals inside it, or in front of it inside a sentence) and after a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str | None, bool]] = {}
        for batch in batches:
            seen, inside, after = Counter(), Counter(), Counter()
            for text in batch.column(1):
                text = text.as_py()
                seen.update(WORD.findall(text) if len(text) <= 4 * STRETCH else (m.group() for m in WORD.finditer(text)))
                inside.update(_INSIDE.findall(text))
                after.update(_COUNTED.findall(text))
            facts: dict[str, list[int]] = {}
            for word, k in seen.items():
                held = known.get(word)
                if held is None:
                    low = word.lower()
                    held = known[word] = (low if xxhash.xxh3_64_intdigest(low) in items else None, any(map(str.isupper, word[1:])) and not word.isupper())
                low, humps = held
                if low is not None:
                    row = facts.setdefault(low, [0, 0, 0])
                    if humps:
                        row[1] += k
                    elif word == low:
                        row[0] += k
                    else:
                        row[1] += min(k, inside[word])
            for word, k in after.items():
                row = facts.get(word.lower())
                if row:
                    row[2] += k
            if len(known) > 1_000_000:  # bounds memory, changes no result
                known.clear()
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in facts], U64).view(np.int64)
            counts = np.array(list(facts.values()), np.int64).reshape(-1, 3)
            yield pa.record_batch([pa.array(hashes), *(pa.array(np.ascontiguousarray(counts[:, c])) for c in range(3)), pa.array([any(map(str.isdigit, w)) for w in facts], pa.bool_())], ["h", "low", "named", "counted", "mixed"])

    return run


def _windows(size: int, lexicon: tuple[Bits, Bits], wanted: tuple[Bits, Bits] | None):
    """mapInArrow over (id, text): the windows of each text that ``wanted`` (rare templates, exact windows) may hold, or all.

    Emits (id, pos, key, by_template, exact, plain, slots): a window that may
    meet another with other values goes by its template, all others by their words.
    """
    names = ["id", "pos", "template", "key", "by_template", "exact", "plain", "slots"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = Lexicon(*lexicon)
        for batch in batches:
            for ids, at, words, total in _stretches(batch, size - 1):
                n = total - size + 1
                if n <= 0:
                    continue
                if len(lex) > lex.most:
                    lex.clear()
                index = np.fromiter(chain.from_iterable(map(lex.__getitem__, part) for part in words), np.int64, total)
                lengths = np.array([len(p) for p in words])
                doc = np.repeat(np.arange(len(words)), lengths)
                pos = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(at, lengths)
                th, xh, slot = np.array(lex.template, U64)[index], np.array(lex.exact, U64)[index], np.array(lex.slot)[index]
                template, exact = np.zeros(n, U64), np.zeros(n, U64)
                for i in range(size):
                    template = template * U64(0x9FB21C651E98DF25) + th[i : i + n]
                    exact = exact * U64(0x8CB92BA72F3D8DD7) + xh[i : i + n]
                template, exact = K.mix(template), K.mix(exact)
                whole = doc[:n] == doc[size - 1 :]
                plain = np.convolve(~slot, np.ones(size, np.int64), "valid").astype(np.int32)
                open_ = whole if wanted is None else whole & wanted[0].holds(template)
                closed = whole if wanted is None else whole & wanted[1].holds(exact)
                for by_template, mask in ((True, open_), (False, closed)):
                    if wanted is None and by_template:
                        continue
                    rows = np.flatnonzero(mask)
                    if not len(rows):
                        continue
                    key = template if by_template else exact
                    values = np.where(slot, xh.view(np.int64), 0)
                    flat = np.lib.stride_tricks.sliding_window_view(values, size)[rows].ravel()
                    slots = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, size, dtype=np.int32)), pa.array(flat))
                    yield pa.record_batch([pa.array([ids[d] for d in doc[rows]], batch.schema[0].type), pa.array(pos[rows].astype(np.int32)), pa.array(template[rows].view(np.int64)), pa.array(key[rows].view(np.int64)), pa.array(np.full(len(rows), by_template)), pa.array(exact[rows].view(np.int64)), pa.array(plain[rows]), slots], names)

    return run


def _hits(documents: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, window: int, opening_share: float, filter_bits: int, scratch: Scratch, word_bits: int = 22) -> DataFrame:
    """(doc_id, p, have, item_id, q, want, rare, same): windows of documents that meet windows of items; ids are (id, hash of the text).

    A window meets others of its template with any values if half of it is
    plain words and at most ``opening_share`` of the items (or one) hold its
    template; all others, openings that many items share and windows of hardly
    anything but placeholders, meet equal words only, so no template is a key
    that joins everything with everything.
    """
    side = lambda df, i, t: df.select(F.struct(F.col(i).alias("id"), F.xxhash64(t).alias("v")).alias("id"), F.col(t).alias("text")).where("id.id is not null and text is not null")
    d, i = side(documents, doc_id, doc_text), side(items, item_id, item_text)
    facts = "h bigint, low bigint, named bigint, counted bigint, mixed boolean"
    vocabulary = Bits.of(i.mapInArrow(_uses(Bits(np.full(1, ~U64(0)))), facts).select("h"), word_bits)
    uses = d.select(F.lit(0), "text").unionByName(i.select(F.lit(0), "text")).mapInArrow(_uses(vocabulary), facts).groupBy("h").agg(F.sum("low").alias("low"), F.sum("named").alias("named"), F.sum("counted").alias("counted"), F.max("mixed").alias("mixed"))
    n = F.col("low") + F.col("named")
    name = F.col("mixed") | (F.col("named") > 0) & (F.col("named") >= NAME_SHARE * n)
    kind = F.when(name, "name").when((F.col("counted") > 0) & (F.col("counted") >= UNIT_SHARE * n), "unit").otherwise("plain")
    uses = scratch.write(uses.select("h", kind.alias("kind")), "uses")
    lexicon = Bits.of(uses.where("kind = 'plain'").select("h"), word_bits), Bits.of(uses.where("kind = 'unit'").select("h"), word_bits)

    kinds = "id struct<id:{},v:bigint>, pos int, template bigint, key bigint, by_template boolean, exact bigint, plain int, slots array<bigint>"
    own = scratch.write(i.mapInArrow(_windows(window, lexicon, None), kinds.format(i.schema["id"].dataType["id"].dataType.simpleString())), "items")
    most = max(1.0, own.select(F.countDistinct("id.v")).first()[0] * opening_share)
    few = own.groupBy("template").agg((F.countDistinct("id.v") <= most).alias("few"))
    own = own.distinct().join(few, "template").withColumn("rare", F.col("few") & (F.col("plain") * 2 >= window))
    own = scratch.write(own.select("id", "pos", "template", "exact", "slots", "rare"), "own")
    wanted = Bits.of(own.where("rare").select("template"), filter_bits), Bits.of(own.where("not rare").select("exact"), filter_bits)
    seen = d.mapInArrow(_windows(window, lexicon, wanted), kinds.format(d.schema["id"].dataType["id"].dataType.simpleString()))
    seen = seen.select(F.col("id").alias("doc_id"), F.col("pos").alias("p"), "key", "by_template", F.col("slots").alias("have"))
    held = own.select(F.col("id").alias("item_id"), F.col("pos").alias("q"), F.when(F.col("rare"), F.col("template")).otherwise(F.col("exact")).alias("key"), F.col("rare").alias("by_template"), F.col("slots").alias("want"), "rare")
    # one template: the words are the same where the slots hold the same
    return seen.join(held, ["key", "by_template"]).drop("key", "by_template").withColumn("same", F.col("have") == F.col("want"))


def leaked_items(documents: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, *, window: int = 12, opening_share: float = 0.1, filter_bits: int = 24, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, item_id, n_windows, first_pos): documents with ``window`` or more consecutive words of an item.

    Words are runs of letters or digits, without case; what stands between them
    is ignored. Template windows join, equal slots decide. Defined results: null
    ids or texts and items of fewer words than the window give no row; one row
    per pair; items with equal passages are all reported; empty tables give an
    empty result; other columns are not read. ``filter_bits`` is the size of the
    bit arrays of item windows that go along with the scan (2 MB each); how many
    items there are changes what passes them, never the result.
    """
    scratch = scratch or Scratch(documents.sparkSession, "leaks")
    hits = _hits(documents, doc_id, doc_text, items, item_id, item_text, window, opening_share, filter_bits, scratch).where("same")
    return hits.groupBy(F.col("doc_id.id").alias("doc_id"), F.col("item_id.id").alias("item_id")).agg(F.countDistinct("p").alias("n_windows"), F.min("p").alias("first_pos"))


def reparameterised_items(documents: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, *, window: int = 12, opening_share: float = 0.1, filter_bits: int = 24, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, item_id, n_words, n_slots, n_changed): passages that repeat an item, verbatim or its template with other values.

    A passage is an aligned run of words that windows cover without a gap. A
    verbatim one (n_changed = 0) counts from ``window`` words, with or without
    slots and whatever surrounds it, so every pair of :func:`leaked_items` is
    here. In a changed one equal item values have equal document values and the
    other way round, and one of its windows is distinctive: at least half of it
    plain words, and held by no more than ``opening_share`` of the items (or by
    one); what more of them share is a common opening. The longest passage of a
    pair is reported. Repeated rows change nothing. Nulls, short and empty texts
    behave as in :func:`leaked_items`.
    """
    scratch = scratch or Scratch(documents.sparkSession, "variants")
    hits = _hits(documents, doc_id, doc_text, items, item_id, item_text, window, opening_share, filter_bits, scratch)
    hits = hits.withColumn("d", F.col("p") - F.col("q")).repartition("doc_id", "item_id", "d")
    w = W.partitionBy("doc_id", "item_id", "d").orderBy("p")
    # windows on one diagonal that leave no word between them make one run; the verbatim ones among them make runs of their own
    before = F.lag("p").over(w)
    same_before = F.last(F.when(F.col("same"), F.col("p")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    apart = lambda x: (F.coalesce(F.col("p") - x, F.lit(window + 1)) > window).cast("int")
    marked = hits.withColumn("gap", apart(before)).withColumn("gap_same", F.when(F.col("same"), apart(same_before)).otherwise(0))
    marked = marked.withColumn("run", F.sum("gap").over(w)).withColumn("run_same", F.when(F.col("same"), F.sum("gap_same").over(w)))
    head = F.struct(F.get("want", F.lit(0)).alias("want"), F.get("have", F.lit(0)).alias("have"))
    side = lambda name: F.size(F.array_distinct(F.transform("s", lambda x: x[name])))
    runs = marked.select("doc_id", "item_id", "d", "p", "want", "have", "rare", head.alias("head"), F.explode(F.filter(F.array(F.struct(F.lit(False).alias("verbatim"), F.col("run").alias("n")), F.struct(F.lit(True).alias("verbatim"), F.col("run_same").alias("n"))), lambda x: x["n"].isNotNull())).alias("r"))
    # the slots of a run: of every window where it begins, and the whole of the last; windows may begin up to their length apart
    held = runs.groupBy("doc_id", "item_id", "d", "r").agg((F.max("p") - F.min("p") + window).alias("n_words"), F.max("rare").alias("rare"), F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("want", "have")))).alias("s"))
    held = held.withColumn("s", F.filter("s", lambda x: x["want"] != 0)).withColumn("n_slots", F.size("s")).withColumn("n_changed", F.size(F.filter("s", lambda x: x["want"] != x["have"])))
    ok = held.where((F.col("n_slots") == side("want")) & (F.col("n_slots") == side("have")) & (F.col("r.verbatim") | F.col("rare")))
    best = ok.groupBy(F.col("doc_id.id").alias("doc_id"), F.col("item_id.id").alias("item_id")).agg(F.max(F.struct("n_words", (-F.col("n_changed")).alias("m"), "n_slots")).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.n_words").alias("n_words"), F.col("b.n_slots").alias("n_slots"), (-F.col("b.m")).alias("n_changed"))
