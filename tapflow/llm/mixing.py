"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources.  Documents are aggregated by their
membership pattern (the set of sources), which leaves a small network: every
pattern may send its words to the quotas of its sources, the first reading of
a word at no cost, each repetition at a growing one (a convex cost, so fresh
words go first and repetitions spread evenly).  The min-cost flow says how
many words each pattern gives; a pattern that gives 1.3 times its size has
each document once and a seeded 30 % of them (by words) once more.

The seeded choice needs the hash below which the documents of a pattern hold
the wanted words.  It is found digit by digit: sizes are summed per pattern
and 12-bit digit of the hash, the digit in which the running sum crosses is
kept, and only the rows of that digit are summed for the next one.  A document
too large for the words still missing is passed over, and the same cut goes on
behind it among those that fit, until none fits.

Defined results: null text has size 0; null source is a source of its own,
last in order; a document of size 0 is never counted; documents equal in key
and size are taken alike; reruns agree; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from itertools import cycle, islice

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapflow.llm.common import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 20240607
DIGIT_BITS, DIGITS = 12, 4
#: Patterns and sources the driver works on, at most.
MAX_PATTERNS = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quotas(sizes: dict, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
           most: float = MAX_REPEATS) -> dict:
    """Words wanted of each source: ``share`` of all words by weight (the
    weights repeat over the sources in code-point order, null last); what
    exceeds ``most`` times a source's size is shared anew by weight."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = dict(zip(order, islice(cycle(weights), len(order))))
    left, free, target = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            free.remove(s)
        left -= sum(target[s] for s in over)
    return target


def min_cost_flow(supply: dict, members: dict, demand: dict, repeats: int = MAX_REPEATS) -> dict:
    """Words from pattern to source: successive shortest paths on the network
    start - pattern (``repeats`` arcs of its size, costs 0, 1, ...) - source -
    end.  Returns {(pattern, source): words}."""
    graph: dict = {}
    arcs: list[list] = []                  # [to, room, cost]; arc i ^ 1 is the way back

    def arc(a, b, room, cost):
        for u, v, r, c in ((a, b, room, cost), (b, a, 0.0, -cost)):
            graph.setdefault(u, []).append(len(arcs))
            arcs.append([v, r, c])

    for p, size in sorted(supply.items(), key=lambda x: str(x[0])):
        for k in range(repeats):
            arc("start", ("p", p), float(size), k)
        for s in members[p]:
            arc(("p", p), ("s", s), float("inf"), 0)
    for s, words in sorted(demand.items(), key=lambda x: str(x[0])):
        arc(("s", s), "end", float(words), 0)
    potential: dict = dict.fromkeys(graph, 0)
    tiny = 1e-9 * (1 + sum(demand.values()))
    while graph:
        best, via, heap, n = {"start": 0}, {}, [(0, 0, "start")], 0
        while heap:
            d, _, u = heapq.heappop(heap)
            if d > best[u]:
                continue
            for i in graph[u]:
                v, room, cost = arcs[i]
                w = d + cost + potential[u] - potential[v]
                if room > tiny and w < best.get(v, float("inf")):
                    best[v], via[v], n = w, i, n + 1
                    heapq.heappush(heap, (w, n, v))
        if "end" not in best:
            break
        for u in graph:
            potential[u] += best.get(u, best["end"])
        path, u = [], "end"
        while u != "start":
            path.append(via[u])
            u = arcs[via[u] ^ 1][0]
        push = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= push
            arcs[i ^ 1][1] += push
    return {(u[1], arcs[i][0][1]): arcs[i ^ 1][1] for u in graph if isinstance(u, tuple) and u[0] == "p"
            for i in graph[u] if isinstance(arcs[i][0], tuple) and arcs[i][0][0] == "s" and arcs[i ^ 1][1] > 0}


def components(members: dict) -> list[list]:
    """Patterns that are linked by common sources, group by group."""
    parent: dict = {}

    def root(s):
        while parent.setdefault(s, s) != s:
            parent[s] = s = parent[parent[s]]
        return s

    for sources in members.values():
        for s in sources[1:]:
            parent[root(s)] = root(sources[0])
    groups: dict = {}
    for p, sources in members.items():
        if sources:
            groups.setdefault(root(sources[0]), []).append(p)
    return list(groups.values())


def flow_by_component(supply: dict, members: dict, demand: dict, repeats: int = MAX_REPEATS) -> dict:
    """``min_cost_flow`` over each group of linked patterns by itself: no
    words pass from one to another, so together these are the flow of the
    whole, and its cost does not grow with sources that do not overlap."""
    flow: dict = {}
    for group in components(members):
        own = {p: members[p] for p in group}
        flow |= min_cost_flow({p: supply[p] for p in group}, own,
                              {s: demand[s] for sources in own.values() for s in sources}, repeats)
    return flow


def _digit(level: int) -> Column:
    return F.shiftright("u", DIGIT_BITS * (DIGITS - 1 - level)).bitwiseAND((1 << DIGIT_BITS) - 1)


def _cuts(rows: DataFrame, state: dict[int, tuple[int, float]]) -> dict[int, tuple[int, int, float]]:
    """``state``: per pattern, the hash to begin at and the words to find
    among the documents from there on that are no larger (``unit``).  Returns
    the hash below which they hold no more than these words, the one to go on
    at, and the words still missing; patterns without such documents are
    left out."""
    spark = rows.sparkSession
    at = {p: (0, w) for p, (_, w) in state.items()}              # prefix of the hash, words still to find
    last: dict = {}
    for level in range(DIGITS):
        if not at:
            break
        here = spark.createDataFrame([(p, c, float(w), float(state[p][1]), state[p][0]) for p, (c, w) in at.items()],
                                     "pattern int, prefix long, w double, cap double, start long")
        # a row per pattern, at most MAX_PATTERNS
        inside = rows.join(F.broadcast(here), "pattern").where(
            (F.shiftright("u", DIGIT_BITS * (DIGITS - level)) == F.col("prefix"))
            & (F.col("u") >= F.col("start")) & (F.col("unit") <= F.col("cap")))
        sums = inside.groupBy("pattern", "prefix", "w", _digit(level).alias("d")).agg(F.sum("size").alias("s"))
        run = Window.partitionBy("pattern").orderBy("d")         # at most 4,096 rows a pattern
        crossed = (sums.withColumn("before", F.sum("s").over(run) - F.col("s"))
                   .where((F.col("before") < F.col("w")))
                   .groupBy("pattern").agg(F.max(F.struct("d", "before", "s")).alias("x")).collect())
        at = {r["pattern"]: ((at[r["pattern"]][0] << DIGIT_BITS) | r["x"]["d"],
                             at[r["pattern"]][1] - r["x"]["before"]) for r in crossed}
        last = {r["pattern"]: r["x"]["s"] for r in crossed}
    # the last documents are taken as well where they still fit
    return {p: (u + 1, u + 1, w - last[p]) if last[p] <= w else (u, u + 1, w) for p, (u, w) in at.items()}


def _ranges(rows: DataFrame, wanted: dict[int, float]) -> dict[int, list[tuple[int, int, float]]]:
    """Per pattern (first hash, hash to stop before, largest size): documents
    in one of these are taken.  Where a document does not fit the words still
    missing, the cut goes on behind it among those that do, until none does."""
    state = {p: (0, w) for p, w in wanted.items() if w > 0}      # hash to begin at, words missing
    ranges: dict[int, list] = {p: [] for p in state}
    while state:
        cuts = _cuts(rows, state)
        for p, (cut, _, _) in cuts.items():
            ranges[p].append((state[p][0], cut, float(state[p][1])))
        state = {p: (after, w) for p, (_, after, w) in cuts.items() if w >= 1}
    return ranges


def mix_sources(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                most: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``rows``: id, size, sources (array of names), and ``key`` where the
    seeded choice should go by another value than the id.  Adds ``taken``,
    words the mix takes of the document, ``copies``, and the first source's
    ``source_size`` and ``target``."""
    spark = rows.sparkSession
    key = F.col("key" if "key" in rows.columns else "id")
    rows = rows.select("id", "size", F.array_sort(F.array_distinct("sources")).alias("sources"),
                       F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, "size"), 64 - DIGIT_BITS * DIGITS).alias("u"))
    patterns = rows.groupBy("sources").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    by_code_point = lambda r: [(s is None, [ord(c) for c in s or ""]) for s in r["sources"]]
    patterns = sorted(patterns, key=by_code_point)
    sizes: dict = {}
    for r in patterns:
        for s in r["sources"]:
            sizes[s] = sizes.get(s, 0) + r["size"]
    target = quotas(sizes, weights, share, most)
    supply = {k: r["size"] for k, r in enumerate(patterns) if r["size"]}
    flow = flow_by_component(supply, {k: patterns[k]["sources"] for k in supply}, target, most)
    given = dict.fromkeys(range(len(patterns)), 0.0)
    for (p, _), n in flow.items():
        given[p] += n

    info, wanted = [], {}
    for k, r in enumerate(patterns):
        size = r["size"]
        base = min(most, int((given[k] + 1e-6) // size)) if size else 0
        wanted[k] = max(0.0, given[k] - base * size) if base < most else 0.0
        first = r["sources"][0] if r["sources"] else None
        info.append((k, list(r["sources"]), base, sizes.get(first, 0), float(target.get(first, 0.0))))
    names = spark.createDataFrame(
        info, "pattern int, names array<string>, base int, source_size long, target double")
    # a row per pattern, at most MAX_PATTERNS; null names compare as equal
    keyed = rows.join(F.broadcast(names), F.col("sources").eqNullSafe(F.col("names")))
    keyed = written(keyed.drop("sources", "names"), "mix-rows")
    # documents equal in key and size are taken alike, so they fit as one or not at all
    alike = written(keyed.where("size > 0").groupBy("pattern", "u").agg(F.sum("size").alias("unit"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").drop("n"), "mix-alike")
    if alike.isEmpty():
        keyed = keyed.withColumn("unit", F.col("size"))
    else:
        keyed = written(keyed.join(alike, ["pattern", "u"], "left").withColumn("unit", F.coalesce("unit", "size")),
                        "mix-units")
    ranges = _ranges(keyed.where("size > 0").select("pattern", "size", "unit", "u"), wanted)
    taken = spark.createDataFrame([(k, ranges.get(k, [])) for k in range(len(patterns))],
                                  "pattern int, ranges array<struct<start:long,stop:long,cap:double>>")
    copies = F.col("base") + F.exists("ranges", lambda r: (F.col("u") >= r["start"]) & (F.col("u") < r["stop"])
                                      & (F.col("unit") <= r["cap"])).cast("int")
    return keyed.join(F.broadcast(taken), "pattern").select(
        "id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
