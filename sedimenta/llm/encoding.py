"""Garbled text from wrong character encoding: found by clean twins, learned, repaired.

A cell is a word with characters beyond ASCII, counted with its numbers masked;
its key is the word without them (numbers masked), or, where little is left,
with its neighbours' too, or else its place in its line stripped of characters
beyond ASCII. Garbled and clean spellings of a word share that key. First every
spelling is aligned with the commonest one of its key that has its characters
beyond ASCII in the same places; what the alignments show as garbled sequence
and original is counted, and the transformations that explain it are inferred:
bytes of one encoding read as another, of any two that the platform knows,
or, where none does, the bare mapping. With these and the usual ones, for each
spelling every transformation (once or twice, then perhaps lower-cased or
stripped of invisible characters) is undone, and the result is looked up among
the spellings of the same key. Which of two spellings is the garbled one is told
by their letters and by what the transformation explains altogether; only where
these say nothing, by the texts that hold either. Transformations with enough
such twins are accepted, and the character mappings learned from the alignments
are applied to cells that have no twin.
"""

from __future__ import annotations

import encodings.aliases
import html
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, spread

LOST = "�"

# Fixed values: (encoding the bytes were in, encoding they were read as). Usual ones, tried even where no alignment shows
# them; others are inferred. A chain whose second part is null is a bare mapping of characters to sequences.
CHAINS = [("utf-8", w) for w in ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251", "cp1250", "cp866", "koi8-r")]
CHAINS += [("cp1252", w) for w in ("cp437", "cp850", "mac_roman", "cp1251", "cp1250", "cp866", "koi8-r")]
CHAINS += [(t, "cp1252") for t in ("mac_roman", "cp437", "cp850", "cp1251", "koi8-r")]
Chain = tuple
#: Encodings of several bytes a character that bytes may have been in.
SEVERAL = ("utf-8", "gb18030", "shift_jis", "euc_jp", "euc_kr", "big5")
DAMAGES = ("", "lower", "upper", "invisible", "twice", "twice lower")

_TOKEN = re.compile(r"[^ \t\r\n\f\v]+")
_EDGE = re.compile(r"^[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+|[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+$")
_BEYOND = re.compile(r"[^\x00-\x7f]+")
_ENTITY = re.compile(r"&(?:#\d{2,7}|#[xX][0-9A-Fa-f]{2,6}|[A-Za-z][A-Za-z0-9]{1,30});")
_INVISIBLE = re.compile("[\x80-\x9f\xa0\xad]")


def unescape(text: str) -> str:
    """Character references for characters beyond ASCII resolved, once-nested ones too."""
    for _ in range(2):
        if "&" not in text:
            break
        text = _ENTITY.sub(lambda m: u if not (u := html.unescape(m.group())).isascii() else (u if u == "&" else m.group()), text)
    return text


@lru_cache(None)
def _table(enc: str) -> list[str]:
    """Byte -> character; bytes an encoding leaves open read as the control of that number."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(enc))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@lru_cache(None)
def _reverse(enc: str) -> dict[str, int]:
    return {ch: b for b, ch in reversed(list(enumerate(_table(enc)))) if b >= 128}


@lru_cache(None)
def single_byte() -> tuple[str, ...]:
    """All encodings of the platform that extend ASCII by single bytes."""
    out = []
    for enc in sorted(set(encodings.aliases.aliases.values())):
        try:
            plain = bytes(range(32, 127)).decode(enc) == bytes(range(32, 127)).decode("ascii")
            n = 0
            for b in range(128, 256):
                try:
                    n += len(bytes([b]).decode(enc)) == 1
                except UnicodeDecodeError:
                    pass
        except (UnicodeError, LookupError, AttributeError, TypeError, ValueError):
            continue
        if plain and n >= 80:
            out.append(enc)
    return tuple(out)


@lru_cache(None)
def _bytes_of(ch: str, enc: str) -> bytes | None:
    if enc not in SEVERAL:
        b = _reverse(enc).get(ch)
        return None if b is None else bytes([b])
    try:
        return ch.encode(enc, "surrogatepass" if enc == "utf-8" else "strict")
    except UnicodeEncodeError:
        return None


@lru_cache(None)
def _bare(chain: Chain) -> dict[str, str]:
    return dict(chain[0])


def garble(text: str, chain: Chain, damage: str = "") -> str:
    """What becomes of a text; characters the true encoding lacks stay as they are."""
    true, wrong = chain
    if wrong is None:
        out = "".join(_bare(chain).get(ch, ch) for ch in text)
    elif true in SEVERAL:
        table = _table(wrong)
        out = "".join(ch if ch.isascii() or (raw := _bytes_of(ch, true)) is None else "".join(table[b] for b in raw) for ch in text)
    else:
        table = _table(wrong)
        back = _reverse(true)
        out = "".join(table[back[ch]] if ch in back else ch for ch in text)
    if damage.startswith("twice"):
        out = garble(out, chain)
    if damage.endswith("lower"):
        return out.lower()
    if damage == "upper":
        return out.upper()
    if damage == "invisible":
        return _INVISIBLE.sub("", out)
    return out


def odd(word: str) -> int:
    """How many characters beyond ASCII no spelling has where they stand: controls, signs inside words, other alphabets beside a to z, wrong case."""
    n = 0
    mixed = any(c.isascii() and c.isalpha() for c in word)
    for i, ch in enumerate(word):
        if ch.isascii():
            continue
        kind, before, after = unicodedata.category(ch), word[i - 1 : i] if i else "", word[i + 1 : i + 2]
        if kind[0] == "L":
            foreign = mixed and (not unicodedata.name(ch, "").startswith("LATIN") or unicodedata.decomposition(ch).startswith("<"))
            n += foreign or ch.isupper() and (before.islower() or before.isalpha() and after.islower()) or ch.islower() and before.isupper() and after.isupper()
        elif kind == "Cc":
            n += 1
        elif kind[0] != "M":
            inside = before.isalpha() and after.isalpha() and kind != "Pd" and ch not in "‘’\xad" and (before + ch + after).lower() != "l·l"
            n += inside or kind in ("No", "Sm", "Sk") and after.isalpha() or kind in ("Sm", "Sk") and before.isalpha() or "─" <= ch <= "◿" and (before.isalpha() or after.isalpha())
    return n


def lean(form: str, original: str, pairs: list[tuple[str, str]]) -> int:
    """What the letters say of a form: 2 garbled from a sound original, 1 garbled, 0 nothing, -1 that it is the sounder one of the two."""
    a, b = odd(form), odd(original)
    # bytes of one character read as several: no spelling undoes into another by chance
    if any(len(x) > 1 for x, _ in pairs) or a > b:
        return 1 if b else 2
    return 0 if a == b else -1


def spelled(core: str) -> str:
    """A word as it is counted: every number as 0, so that amounts do not make new spellings."""
    return re.sub("[0-9]+", "0", core)


def respell(core: str, fixed: str) -> str | None:
    """A word with the characters beyond ASCII of its repaired spelling; null if their places differ."""
    runs, gaps = _BEYOND.findall(fixed), _BEYOND.split(core)
    if len(gaps) != len(runs) + 1:
        return None
    return gaps[0] + "".join(r + g for r, g in zip(runs, gaps[1:]))


def mask(word: str) -> str:
    """A word without characters beyond ASCII: letters in lower case, each number as 0."""
    return re.sub(r"\d+", "0", re.sub(r"[^a-z0-9]+", "", _BEYOND.sub("", word).lower()))


def cells(text: str) -> Iterator[tuple[int, int, str, int]]:
    """(start, end, spelling, key) of the words of an unescaped text that hold characters beyond ASCII.

    Where neither a word nor its neighbours have two ASCII letters, as in other
    alphabets, the key is the ASCII part of its line, with all runs of other
    characters as one mark, and the word's number in the line.
    """
    before = after = None
    line, line_end, shape, number = 0, -1, "", 0
    ahead = _TOKEN.finditer(text)
    m = next(ahead, None)
    while m is not None:
        after = next(ahead, None)
        word = m.group()
        if not word.isascii():
            core = _EDGE.sub("", word)
            at = m.start() + word.index(core)
            key = own = mask(core)
            if sum(c.isalpha() for c in own) < 2:
                left, right = mask(before.group()) if before else "", mask(after.group()) if after else ""
                key = f"{left} {own} {right}"
                if sum(c.isalpha() for c in key) < 2:
                    if m.start() > line_end:
                        line = text.rfind("\n", 0, m.start()) + 1
                        line_end = text.find("\n", m.start())
                        line_end = len(text) if line_end < 0 else line_end
                        shape, number = re.sub(r"\d+", "0", _BEYOND.sub("\x01", text[line:line_end])), 0
                        counted = line
                    number += len(_TOKEN.findall(text, counted, m.start()))
                    counted = m.start()
                    key = f"{shape}\n{number}"
            yield at, at + len(core), core, xxhash.xxh3_64_intdigest(key) - (1 << 63)
        before, m = m, after


class Undo:
    """Inverse transformations over a known alphabet (characters that occur in the corpus)."""

    def __init__(self, alphabet: list[str], allowed: set[tuple[int, str]] | None = None, chains: list[Chain] = CHAINS):
        self.maps: list[tuple[int, str, dict[str, str], int]] = []
        for c, chain in enumerate(chains):
            for damage in DAMAGES:
                if allowed is not None and (c, damage) not in allowed:
                    continue
                if damage.startswith("twice") and chain[0] not in SEVERAL:
                    continue
                table: dict[str, str] = {}
                changed = False
                for ch in alphabet:
                    seq = garble(ch, chain, damage)
                    if seq and seq != ch and not seq.isascii():
                        table.setdefault(seq, ch)
                        changed = changed or seq != garble(ch, chain)
                if table and (damage in ("", "twice") or changed):
                    self.maps.append((c, damage, table, max(map(len, table))))

    @staticmethod
    @lru_cache(4)
    def shared(alphabet: str, allowed: frozenset | None, chains: tuple[Chain, ...]) -> Undo:
        """One for all tasks of a worker."""
        return Undo(list(alphabet), allowed, list(chains))

    @staticmethod
    def run(run: str, table: dict[str, str], longest: int, whole: bool) -> list[tuple[str, str]] | None:
        """A run cut into (garbled sequence, character); None if that fails or changes nothing.

        Longest sequences first. Unless ``whole``, characters without a mapping stay.
        """
        out, i, hit = [], 0, False
        while i < len(run):
            for n in range(min(longest, len(run) - i), 0, -1):
                ch = table.get(run[i : i + n])
                if ch is not None:
                    out.append((run[i : i + n], ch))
                    i, hit = i + n, True
                    break
            else:
                if whole:
                    return None
                out.append((run[i], run[i]))
                i += 1
        return out if hit else None

    def word(self, spelling: str) -> Iterator[tuple[str, int, str, list[tuple[str, str]]]]:
        """(original, chain, damage, aligned sequences) for every transformation that may have made the spelling."""
        runs = _BEYOND.findall(spelling)
        gaps = _BEYOND.split(spelling)
        seen = set()
        for c, damage, table, longest in self.maps:
            parts = [self.run(r, table, longest, False) for r in runs]
            if not any(parts):
                continue
            aligned = [p or [(ch, ch) for ch in r] for p, r in zip(parts, runs)]
            original = gaps[0] + "".join("".join(ch for _, ch in p) + g for p, g in zip(aligned, gaps[1:]))
            if original != spelling and (original, c, damage) not in seen:
                seen.add((original, c, damage))
                yield original, c, damage, [(a, b) for p in aligned for a, b in p if a != b]


def aligned(form: str, like: str) -> list[tuple[str, str]]:
    """(garbled sequence, original) of two spellings with the same ASCII parts; the garbled one by length and letters, nothing if these do not tell."""
    pairs = [(a, b) for a, b in zip(_BEYOND.findall(form), _BEYOND.findall(like)) if a != b]
    if not pairs or LOST in form or LOST in like:
        return []
    if odd(form) < odd(like):
        form, like, pairs = like, form, [(b, a) for a, b in pairs]
    if odd(form) <= odd(like) or any(len(a) < len(b) for a, b in pairs):
        return []
    out = []
    for a, b in pairs:
        k = len(a) // len(b)
        if len(a) == k * len(b):
            out += [(a[i * k : i * k + k], ch) for i, ch in enumerate(b)]
    return [(a, b) for a, b in out if a != b]


def _align_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(key, a, b) for key, form, like in zip(*(c.to_pylist() for c in batch.columns)) for a, b in set(aligned(form, like))]
        columns = list(zip(*rows)) if rows else [[]] * 3
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string()))], ["key", "garbled", "original"])


def infer(seen: list[tuple[str, str, int]], min_words: int, known: list[Chain] = CHAINS) -> list[Chain]:
    """Transformations beyond the known ones that explain (garbled sequence, original, words that show it).

    Any two encodings of the platform, the one that explains most words first,
    as long as it explains two characters and ``min_words`` words that none before
    does; what no two encodings explain is a bare mapping if ``min_words`` words
    and nine in ten of those with the sequence show it.
    """
    damages = ("", "lower", "upper", "twice")
    cases = lambda ch: {ch, ch.lower(), ch.upper()}

    def explains(chain: Chain, seq: str, ch: str) -> bool:
        return any(garble(c, chain, d) == seq for c in cases(ch) for d in damages if d != "twice" or chain[0] in SEVERAL)

    left = [(a, b, n) for a, b, n in seen if not any(explains(chain, a, b) for chain in known)]
    out: list[Chain] = []
    while left:
        votes: Counter[Chain] = Counter()
        chars: dict[Chain, set[str]] = defaultdict(set)
        for a, b, n in left:
            sources: dict[bytes, list[str]] = defaultdict(list)
            for enc in (*SEVERAL, *single_byte()):
                raw = _bytes_of(b, enc)
                if raw is not None:
                    sources[raw].append(enc)
            for wrong in single_byte():
                back = _reverse(wrong)
                if all(ch in back for ch in a):
                    for true in sources.get(bytes(back[ch] for ch in a), ()):
                        if true != wrong:
                            votes[true, wrong] += n
                            chars[true, wrong].add(b.lower())
        good = [c for c, n in votes.items() if n >= min_words and len(chars[c]) >= 2]
        if not good:
            break
        best = min(good, key=lambda c: (-votes[c], c[0] not in SEVERAL, c))
        out.append(best)
        left = [(a, b, n) for a, b, n in left if not explains(best, a, b)]
    total: Counter[str] = Counter()
    for a, _, n in seen:
        total[a] += n
    bare = sorted((b, -n, a) for a, b, n in left if n >= min_words and n >= 0.9 * total[a])
    while bare:
        first: dict[str, str] = {}
        for b, _, a in bare:
            first.setdefault(b, a)
        out.append((tuple(sorted(first.items())), None))
        bare = [(b, n, a) for b, n, a in bare if first[b] != a]
    return out


def _cell_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys, forms, texts = [], [], [], []
        for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = unescape(text)
            for key, form in {(key, spelled(core)) for _, _, core, key in cells(text)} if not text.isascii() else ():
                ids.append(rid)
                keys.append(key)
                forms.append(form)
            if len(ids) > len(texts):
                texts += [xxhash.xxh3_64_intdigest(text) - (1 << 63)] * (len(ids) - len(texts))
        yield pa.record_batch([pa.array(ids, batch.column(0).type), pa.array(keys, pa.int64()), pa.array(forms, pa.string()), pa.array(texts, pa.int64())], ["id", "key", "form", "t"])


def fill(form: str, like: str) -> str:
    """A spelling whose lost characters come from another of the same key, run by run; capital next to capitals."""
    have, want = list(_BEYOND.finditer(form)), _BEYOND.findall(like)
    if len(have) != len(want) or any(len(a.group()) != len(b) for a, b in zip(have, want)):
        return form
    out, at = [], 0
    for m, b in zip(have, want):
        before, after = form[m.start() - 1 : m.start()], form[m.end() : m.end() + 1]
        capital = (before.isupper() or not before) and (after.isupper() or not after) and (before + after)
        out += [form[at : m.start()], "".join((y.upper() if capital else y) if x == LOST else x for x, y in zip(m.group(), b))]
        at = m.end()
    return "".join(out) + form[at:]


def _fill_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(key, form, fill(form, like) if like is not None else fixed) for key, form, fixed, like in zip(*(c.to_pylist() for c in batch.columns))]
        columns = list(zip(*rows)) if rows else [[]] * 3
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string()))], ["key", "form", "fixed"])


class Repair:
    """found(): garbled documents; repaired(): with their original text; learned(): the accepted mappings."""

    def __init__(self, base: DataFrame, cell_table: DataFrame, forms: DataFrame, garbled: DataFrame, mappings: list[tuple], scratch: Scratch):
        self.base, self.cells, self.forms, self.garbled, self.mappings, self.scratch = base, cell_table, forms, garbled, mappings, scratch

    def found(self) -> DataFrame:
        """(id): every document with a garbled cell."""
        return self.cells.join(self.garbled.select("key", "form"), ["key", "form"], "left_semi").select("id").distinct()

    def learned(self) -> DataFrame:
        """(true_encoding, read_as, damage, garbled, original, n_docs)."""
        return self.base.sparkSession.createDataFrame(self.mappings, "true_encoding string, read_as string, damage string, garbled string, original string, n_docs long")

    def repaired(self) -> DataFrame:
        """(id, text, recovered): garbled documents with what could be restored; recovered if nothing garbled is left."""
        fixes = self.cells.join(self.garbled, ["key", "form"]).groupBy("id").agg(F.collect_list(F.struct("key", "form", "fixed")).alias("fixes"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, texts, whole = [], [], []
                for rid, text, fixed in zip(*(c.to_pylist() for c in batch.columns)):
                    known = {(f["key"], f["form"]): f["fixed"] for f in fixed}
                    text = unescape(text)
                    out, at, ok = [], 0, True
                    for start, end, core, key in cells(text):
                        form = spelled(core)
                        if (key, form) in known:
                            better = known[key, form] and respell(core, known[key, form])
                            ok = ok and better is not None and LOST not in better
                            out += [text[at:start], core if better is None else better]
                            at = end
                    ids.append(rid)
                    texts.append("".join(out) + text[at:])
                    whole.append(ok)
                yield pa.record_batch([pa.array(ids, batch.column(0).type), pa.array(texts, pa.string()), pa.array(whole, pa.bool_())], ["id", "text", "recovered"])

        kind = self.base.schema["id"].dataType.simpleString()
        return self.base.join(fixes, "id").select("id", "text", "fixes").mapInArrow(run, f"id {kind}, text string, recovered boolean")


def repair_encoding(df: DataFrame, id_col: str, text_col: str, *, min_support: int = 3, scratch: Scratch | None = None) -> Repair:
    """Find and restore texts with characters read in a wrong encoding.

    A transformation is accepted with twins in ``min_support`` documents, and
    inferred from as many words (see :func:`infer`). Where
    its letters speak for it as a whole, and more than for its inverse, its twins
    are garbled however common they are, but for those whose letters say the
    contrary; twins of the others are garbled if the clean word stands in at least
    as many distinct texts, so that copies vote only in a tie. The driver receives the corpus alphabet and the learned mappings only; both are
    bounded by the number of code points, whatever the corpus.

    Defined results: null ids and null or plain ASCII texts (but for character
    references) are not garbled; U+FFFD always is; repeated rows change
    nothing; an empty table gives an empty result; other columns are not read.
    """
    scratch = scratch or Scratch(df.sparkSession, "encoding")
    base = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    kind = base.schema["id"].dataType.simpleString()
    cell = scratch.write(base.mapInArrow(_cell_rows, f"id {kind}, key bigint, form string, t bigint"), "cells")
    # n: documents that hold a spelling; texts: distinct texts
    forms = cell.groupBy("key", "form", "t").agg(F.countDistinct("id").alias("n")).groupBy("key", "form").agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
    forms = scratch.write(forms, "forms")

    chars = forms.select(F.explode(F.array_distinct(F.split("form", ""))).alias("ch")).where(F.length("ch") > 0).distinct()
    alphabet = "".join(sorted(r["ch"] for r in chars.collect() if not r["ch"].isascii() and r["ch"] != LOST))

    # Every spelling against the commonest of its key with the same ASCII parts: a star, so a key of many spellings costs no pairs.
    parts = forms.withColumn("parts", F.regexp_replace(F.lower("form"), r"[^\x00-\x7f]+", "\u0001"))
    common = parts.groupBy("key", "parts").agg(F.max_by("form", F.struct("texts", "form")).alias("like"), F.count("*").alias("k")).where("k > 1")
    shown = parts.join(common, ["key", "parts"]).where("form <> like").select("key", "form", "like").mapInArrow(_align_rows, "key bigint, garbled string, original string")
    shown = shown.groupBy("garbled", "original").agg(F.countDistinct("key").alias("words")).collect()
    chains = tuple(CHAINS) + tuple(infer([tuple(r) for r in shown], min_support))
    inverse = {c: chains.index((w, t)) for c, (t, w) in enumerate(chains) if (w, t) in chains}
    several = [t in SEVERAL or w is None for t, w in chains]

    guess_schema = "key bigint, form string, n bigint, original string, low string, chain int, damage string, lean int, pairs array<struct<garbled:string,original:string>>"

    def guesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        undo = Undo.shared(alphabet, None, chains)
        for batch in batches:
            rows = []
            for key, form, n in zip(*(c.to_pylist() for c in batch.columns)):
                for original, c, damage, pairs in undo.word(form):
                    rows.append((key, form, n, original, original.lower(), c, damage, lean(form, original, pairs), [{"garbled": a, "original": b} for a, b in pairs]))
            columns = list(zip(*rows)) if rows else [[]] * 9
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.struct([("garbled", pa.string()), ("original", pa.string())]))]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "form", "n", "original", "low", "chain", "damage", "lean", "pairs"])

    low = F.lower("form")  # twins may differ in case
    common = forms.groupBy("key", low.alias("low")).agg(F.struct(F.sum("texts").alias("texts"), F.sum("n").alias("docs")).alias("clean"))
    own = common.select("key", F.col("low").alias("own"), F.col("clean").alias("n_own"))
    twins = spread(forms.select("key", "form", "n"), "key", "form").mapInArrow(guesses, guess_schema).withColumn("own", low).where("own <> low").join(common, ["key", "low"]).join(own, ["key", "own"])
    twins = scratch.write(twins, "all_twins")

    # Distinct spellings with a sound original speak for a chain, against those for its inverse: no word's majority can turn them.
    votes = {r["chain"]: r["n"] for r in twins.where("lean = 2").groupBy("chain").agg(F.countDistinct("key", "form").alias("n")).collect()}
    spoken = [(c, n >= min_support and n > 2 * m, m >= min_support and m > 2 * n) for c, n, m in ((c, votes.get(c, 0), votes.get(inverse.get(c), 0)) for c in range(len(chains)))]
    spoken = df.sparkSession.createDataFrame(spoken, "chain int, sure boolean, inverse boolean")
    told = "lean = 2 and (sure or clean >= n_own) or lean = 1 and clean >= n_own or lean = 0 and not inverse and (clean >= n_own or sure and damage = '')"
    twins = twins.join(F.broadcast(spoken), "chain").where(told).drop("own", "n_own", "sure", "inverse")
    twins = scratch.write(twins, "twins")
    scratch.drop("all_twins")

    # What each transformation explains; undamaged and better supported ones first.
    support = {(r["chain"], r["damage"]): r["n"] for r in twins.groupBy("chain", "damage").agg(F.sum("n").alias("n")).collect()}
    accepted = {k for k, n in support.items() if n >= min_support}
    order = sorted(accepted, key=lambda k: (DAMAGES.index(k[1]), -support[k], k))
    ranking = df.sparkSession.createDataFrame([(c, d, i) for i, (c, d) in enumerate(order)], "chain int, damage string, rank int")
    best = twins.join(F.broadcast(ranking), ["chain", "damage"])
    # a twin whose letters tell explains a spelling, then the commonest; then the better ranked transformation
    best = best.groupBy("key", "form").agg(F.max(F.struct("lean", F.col("clean"), (-F.col("rank")).alias("minus"), "original", "chain", "damage", "pairs", "n")).alias("b")).select("key", "form", "b.*")
    best = scratch.write(best, "best")

    # Learned: sequence -> character with the documents that show it, against those where the sequence is clean.
    mapped = best.select("chain", "damage", F.explode("pairs").alias("p"), "n").groupBy("chain", "damage", "p.garbled", "p.original").agg(F.sum("n").alias("n_docs"))
    learned = [(r["chain"], r["damage"], r["garbled"], r["original"], r["n_docs"]) for r in mapped.collect()]
    clean = forms.join(best.select("key", "form"), ["key", "form"], "left_anti").select(F.explode(F.array_distinct(F.split("form", ""))).alias("ch"), "n").groupBy("ch").agg(F.sum("n").alias("n"))
    clean_docs = {r["ch"]: r["n"] for r in clean.collect() if not r["ch"].isascii()}
    single: Counter[str] = Counter()
    for _, _, a, _, n in learned:
        if len(a) == 1:
            single[a] += n
    foreign = {a for a, n in single.items() if n >= min_support and clean_docs.get(a, 0) <= n // 4}
    # Sequences changed in case may be letters of a clean word: they count where hardly any spelling without a twin has them.
    cased: Counter[str] = Counter()
    for _, d, a, _, n in learned:
        if len(a) > 1 and d in ("lower", "upper"):
            cased[a] += n
    shown = df.sparkSession.createDataFrame([(a,) for a in sorted(cased)], "a string")
    shown = forms.join(best.select("key", "form"), ["key", "form"], "left_anti").join(F.broadcast(shown), F.contains("form", "a")).groupBy("a").agg(F.sum("n").alias("n"))
    elsewhere = {r["a"]: r["n"] for r in shown.collect()} if cased else {}
    rare = {a for a, n in cased.items() if n >= min_support and elsewhere.get(a, 0) <= n // 4}
    kept = frozenset((c, d) for c, d, *_ in learned)
    known = "".join(ch for ch in alphabet if clean_docs.get(ch, 0) >= min_support)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        undo = Undo.shared(known, kept, chains)
        tables: dict[tuple[int, str], set[str]] = defaultdict(set)
        for c, d, a, _, _ in learned:
            tables[c, d].add(a)
        for batch in batches:
            rows = []
            for key, form in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                verdict = None
                for original, c, damage, pairs in undo.word(form):
                    sequences = [a for a, b in pairs if len(a) > 1 and several[c] and (damage not in ("lower", "upper") or a in rare)]
                    inside = [a for a, b in pairs if len(a) == 1 and a in foreign and a in tables[c, damage] and re.search(r"[A-Za-z]", form)]
                    # a letter that clean words have, too, counts only where the word gets sounder
                    told = lean(form, original, pairs)
                    inside = [a for a in inside if told > 0 or told == 0 and clean_docs.get(a, 0) < min_support]
                    score = (len("".join(sequences)) * 2 + len(inside), -order.index((c, damage)))
                    if (sequences or inside) and (verdict is None or score > verdict[0]):
                        verdict = (score, original)
                if verdict:
                    rows.append((key, form, verdict[1]))
                elif LOST in form:
                    rows.append((key, form, None))
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string()))], ["key", "form", "fixed"])

    without = forms.join(best.select("key", "form"), ["key", "form"], "left_anti").select("key", "form")
    without = spread(without, "key", "form").mapInArrow(rest, "key bigint, form string, fixed string")
    # Lost characters: restored from the commonest clean spelling of the key with the same length and ASCII characters, whose others fit, too.
    visible = F.regexp_replace(low, r"[^\x00-\x7f]", "\u0001")
    lost = without.where(F.col("form").contains(LOST)).select("key", low.alias("lost"), visible.alias("visible")).distinct()
    pattern = F.concat(F.lit("^"), F.replace(F.regexp_replace("lost", r"([!-/:-@\[-`{-~])", r"\\$1"), F.lit(LOST), F.lit(r"[^\x00-\x7f]")), F.lit("$"))
    whole = forms.where(~F.col("form").contains(LOST)).select("key", visible.alias("visible"), F.col("form").alias("like"), "n")
    choice = whole.join(lost, ["key", "visible"]).where(F.rlike(F.lower("like"), pattern)).groupBy("key", "lost").agg(F.max_by("like", F.struct("n", "like")).alias("like"))
    filled = without.withColumn("lost", low).join(choice, ["key", "lost"], "left").select("key", "form", "fixed", "like")
    without = filled.mapInArrow(_fill_rows, "key bigint, form string, fixed string")
    garbled = scratch.write(best.select("key", "form", F.col("original").alias("fixed")).unionByName(without), "garbled")
    mappings = [(*(chains[c] if chains[c][1] else ("unknown", "unknown")), d, a, b, n) for c, d, a, b, n in learned]
    return Repair(base, cell, forms, garbled, mappings, scratch)
