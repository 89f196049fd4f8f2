"""Splits that keep related records together.

Apps are related by folder, by author and by object of their candidates. Every
relation is a key held by apps; each key ties its apps to its smallest one (a
star, never all pairs), components of the stars come from hooking and
shortcutting, and whole components are dealt to the splits so that the counts
of candidates come as close to the wanted shares as subset sums allow.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.paths import path_parts, place
from ..operators.components import components
from ..session import Scratch

# Author entries that name nobody, and accounts that are no person.
PLACEHOLDERS = ("", "-", "?", "n/a", "na", "none", "null", "nil", "unknown", "anonymous", "tbd", "todo", "author", "user", "noreply", "no-reply", "admin", "root", "system")
AUTOMATION = (
    r"(^|[-\[])(bot|robot|ci|cd|ci-cd|agent|automation|automerge|autofix|pipeline|pipelines|runner|scheduler|daemon|cron|jenkins|dependabot|renovate|github-actions|actions-user|azure-pipelines|"
    r"build|builder|buildbot|build-agent|build-service|merge-queue|merge-bot|release-bot|release-manager-bot|service-account|svc|deploy|deployer|web-flow|semantic-release|snyk|mergify)\]?$"
)


def person(author: F.Column) -> F.Column:
    """One spelling per person: no '@', address part, case, blanks or differing separators; null for nobody and for automation."""
    a = F.lower(F.trim(author))
    a = F.regexp_replace(a, r"^@+|<[^>]*>$", "")
    a = F.regexp_replace(F.trim(a), r"@.*$", "")
    a = F.regexp_replace(F.trim(a), r"[\s._-]+", "-")
    plain = F.lower(F.trim(author))
    return F.when(a.isin(*PLACEHOLDERS) | plain.isin(*PLACEHOLDERS) | a.rlike(AUTOMATION), None).otherwise(a)


def thing(obj: F.Column) -> F.Column:
    """Kind and name of an object without case, quotes and surplus blanks; null if nothing is left."""
    o = F.trim(F.regexp_replace(F.regexp_replace(F.lower(obj), "[\"'`“”]", " "), r"\s+", " "))
    return F.when(o == "", None).otherwise(o)


@dataclass
class Related:
    """apps(app, root): the component of every app, named by its smallest app."""

    apps: DataFrame
    placed: DataFrame
    scratch: Scratch

    def pairs(self) -> DataFrame:
        """(app_a, app_b), smaller first: all pairs of apps of one component."""
        x, y = self.apps.alias("x"), self.apps.alias("y")
        return x.join(y, F.col("x.root") == F.col("y.root")).where(F.col("x.app") < F.col("y.app")).select(F.col("x.app").alias("app_a"), F.col("y.app").alias("app_b"))


def related_apps(apps: DataFrame, candidates: DataFrame, scratch: Scratch | None = None, spokes: int = 4096) -> Related:
    """Components of apps tied by folder, person or object.

    ``apps``: app, app_dir; ``candidates``: path, author, object (all others are
    not read). Defined results: null or placeholder authors, null or blank
    objects and candidates outside every app tie nothing; an app without ties
    is its own component; rows repeated change nothing; empty tables give an
    empty result.
    """
    scratch = scratch or Scratch(apps.sparkSession, "related")
    apps = apps.select(F.col("app").cast("long").alias("app"), "app_dir").where("app is not null").distinct()
    facts = candidates.select("path", person(F.col("author")).alias("author"), thing(F.col("object")).alias("object")).where("path is not null").distinct()
    facts = scratch.write(facts, "facts")
    placed = scratch.write(place(facts.select("path"), apps), "placed")
    held = facts.where("author is not null or object is not null").join(placed, "path")
    held = held.select("app", F.explode(F.array(F.struct(F.lit("author").alias("kind"), F.col("author").alias("value")), F.struct(F.lit("object").alias("kind"), F.col("object").alias("value")))).alias("k")).select("app", "k.kind", "k.value")
    parts = path_parts(F.col("app_dir"))
    folder = apps.select("app", F.lit("folder").alias("kind"), F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/").alias("value"))
    keys = held.unionByName(folder).where("value is not null and value <> ''").distinct()
    # a key of very many apps ties them to the smallest of their bin, and the bins to the smallest of all: no hub has more than `spokes` edges of either kind
    hubs = keys.groupBy("kind", "value").agg(F.min("app").alias("hub"), F.count("*").alias("n")).where("n > 1")
    held = keys.join(hubs, ["kind", "value"]).withColumn("bin", F.pmod(F.xxhash64("app"), F.ceil(F.col("n") / spokes)))
    held = scratch.write(held.select("kind", "value", "hub", "bin", "app"), "held")
    bins = held.groupBy("kind", "value", "hub", "bin").agg(F.min("app").alias("local"))
    edges = held.join(bins, ["kind", "value", "hub", "bin"]).select(F.col("local").alias("hub"), "app").unionByName(bins.select("hub", F.col("local").alias("app"))).where("app <> hub")
    found = components(edges, scratch, "apps")
    whole = apps.select("app").distinct().join(found.select(F.col("node").alias("app"), "root"), "app", "left").select("app", F.coalesce("root", "app").alias("root"))
    return Related(scratch.write(whole, "roots"), placed, scratch)


def choose(histogram: list[tuple[int, int]], goal: int, residual: int = 1 << 25) -> dict[int, int]:
    """How many groups of each size to take so that the sizes sum as close to ``goal`` as possible.

    Bitset subset sums over sizes with multiplicities; for every sum the step
    that reached it first is kept (four bytes), so memory follows the goal and
    not the number of sizes. Goals beyond ``residual`` first take largest groups
    until the rest is within it, which bounds bitset and steps (300 MB at the
    default); the sum is then the closest one that holds those groups, and no
    other is closer where it meets the goal. Among equally close sums the
    smaller is taken.
    """
    taken: dict[int, int] = {}
    left = {s: n for s, n in histogram if s > 0 and n > 0}
    rest = max(0, goal)
    for size in sorted(left, reverse=True):
        if rest <= residual:
            break
        n = min(left[size], max(0, (rest - residual // 2) // size))
        if n:
            taken[size], left[size], rest = n, left[size] - n, rest - n * size
    sizes = [(s, n) for s, n in sorted(left.items(), reverse=True) if n]
    if sum(s * n for s, n in sizes) <= rest:
        for s, n in sizes:
            taken[s] = taken.get(s, 0) + n
        return taken
    # what largest-first leaves open bounds how far a closer sum may be beyond the goal
    gap = rest
    for s, n in sizes:
        gap -= min(n, gap // s) * s
    limit = rest + gap
    first = np.zeros(limit + 1, np.uint32)
    mask, reach, steps = (1 << (limit + 1)) - 1, 1, []
    for size, count in sizes:
        power = 1
        while count > 0 and not reach >> rest & 1:
            n = min(power, count)
            count, power = count - n, power * 2
            if size * n > limit:
                continue
            steps.append((size, n))
            moved = (reach << (size * n)) & mask
            new = moved ^ (moved & reach)
            if new:
                first[_bits(new)] = len(steps)
                reach |= new
    best = min((abs(t - rest), t) for t in _near(reach, rest))[1]
    while best:
        size, n = steps[first[best] - 1]
        taken[size] = taken.get(size, 0) + n
        best -= size * n
    return taken


def _bits(x: int) -> np.ndarray:
    """Positions of the ones of a number."""
    raw = np.frombuffer(x.to_bytes(-(-x.bit_length() // 8), "little"), np.uint8)
    some = np.flatnonzero(raw)
    row, col = np.nonzero(np.unpackbits(raw[some, None], axis=1, bitorder="little"))
    return some[row] * 8 + col


def _near(reach: int, goal: int) -> list[int]:
    """The reachable sums next to the goal, below (or at) and above."""
    below = reach & ((1 << (goal + 1)) - 1)
    above = reach >> (goal + 1)
    out = [below.bit_length() - 1]
    if above:
        out.append(goal + 1 + (above & -above).bit_length() - 1)
    return out


def assign_splits(groups: DataFrame, shares: dict[str, float], scratch: Scratch, seed: int = 17) -> DataFrame:
    """(grp, split) for groups(grp, size): whole groups dealt so that sizes come closest to the shares.

    Splits are filled in the order of ascending share; the last takes the rest.
    The driver sees one row per distinct size (their number grows as the square
    root of the records), and works in memory bounded by :func:`choose`. Which groups of one size go where follows a seeded
    hash; they are ranked in 1024 buckets, so a size that most groups have is
    never one task. Groups of size 0 follow the hash alone.
    """
    groups = scratch.write(groups, "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    histogram = {int(r[0]): int(r[1]) for r in groups.where("size > 0").groupBy("size").count().toLocalIterator()}
    order = sorted(shares, key=lambda s: (shares[s], s))
    quota: list[tuple[str, dict[int, int]]] = []
    left = dict(histogram)
    for name in order[:-1]:
        take = choose(list(left.items()), int(total * shares[name] + 0.5))
        quota.append((name, take))
        left = {s: n - take.get(s, 0) for s, n in left.items()}
    limits = [(s, i, name, take.get(s, 0)) for i, (name, take) in enumerate(quota) for s in histogram if take.get(s, 0)]
    ranges, done = [], {}
    for s, _, name, n in sorted(limits):
        ranges.append((s, done.get(s, 0), done.get(s, 0) + n, name))
        done[s] = done.get(s, 0) + n
    table = groups.sparkSession.createDataFrame(ranges, "size long, low long, high long, split string")
    h = F.xxhash64(F.col("grp"), F.lit(seed))
    g = groups.select("grp", F.col("size").cast("long").alias("size"), h.alias("h"), F.pmod(h, F.lit(1024)).alias("bucket"))
    inner = g.where("size > 0").withColumn("n", F.row_number().over(W.partitionBy("size", "bucket").orderBy("h", "grp")))
    ahead = g.where("size > 0").groupBy("size", "bucket").count().withColumn("ahead", F.sum("count").over(W.partitionBy("size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)))
    ranked = inner.join(ahead.select("size", "bucket", F.coalesce("ahead", F.lit(0)).alias("ahead")), ["size", "bucket"]).select("grp", "size", (F.col("n") + F.col("ahead") - 1).alias("rank"))
    dealt = ranked.alias("r").join(table.alias("t"), (F.col("r.size") == F.col("t.size")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")), "left").select("grp", F.coalesce("split", F.lit(order[-1])).alias("split"))
    u = F.pmod(F.shiftright(F.col("h"), 10), F.lit(1_000_000)) / 1e6
    edge, pick = 0.0, F.lit(order[-1])
    for name in reversed(order[:-1]):
        pick = F.when((u >= edge) & (u < edge + shares[name]), name).otherwise(pick)
        edge += shares[name]
    return dealt.unionByName(g.where("size = 0").select("grp", pick.alias("split")))


def group_splits(apps: DataFrame, members: DataFrame, candidates: DataFrame, shares: dict[str, float], scratch: Scratch | None = None) -> DataFrame:
    """(origin, record_id, app, grp, split): every member and candidate with its group and split; groups of related apps are named app:smallest.

    ``apps``: app, app_dir; ``members``: record_id, path, app_dir; ``candidates``:
    record_id, path, author, object. Shares are of candidates. Records in no app
    are kept together by folder, and alone where they have no path. Defined
    results: null ids are left out, repeated rows of one id count once.
    """
    scratch = scratch or Scratch(apps.sparkSession, "splits")
    related = related_apps(apps, candidates, scratch)
    m = members.select("record_id", "path", "app_dir").where("record_id is not null").dropDuplicates(["record_id"])
    c = candidates.select("record_id", "path").where("record_id is not null").dropDuplicates(["record_id"]).withColumn("app_dir", F.lit(None).cast("string"))
    records = m.withColumn("origin", F.lit("members")).unionByName(c.withColumn("origin", F.lit("candidates")))
    where = scratch.write(place(records.select(F.explode(F.array("path", "app_dir"))), apps.select(F.col("app").cast("long").alias("app"), "app_dir").distinct()), "where")
    by_path, by_dir = where.select("path", F.col("app").alias("app_p")), where.select(F.col("path").alias("app_dir"), F.col("app").alias("app_d"))
    located = records.join(by_path, "path", "left").join(by_dir, "app_dir", "left").withColumn("app", F.coalesce("app_p", "app_d"))
    parts = path_parts(F.col("path"))
    alone = F.when(F.size(parts) > 1, F.concat(F.lit("folder:"), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"))).otherwise(F.concat_ws(":", "origin", F.col("record_id").cast("string")))
    located = located.join(related.apps, "app", "left").select("origin", "record_id", "app", F.coalesce(F.concat(F.lit("app:"), F.col("root").cast("string")), alone).alias("grp"))
    located = scratch.write(located, "located")
    groups = located.groupBy("grp").agg(F.sum((F.col("origin") == "candidates").cast("long")).alias("size"))
    return located.join(assign_splits(groups, shares, scratch), "grp").select("origin", "record_id", "app", "grp", "split")
