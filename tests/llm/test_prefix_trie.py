import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tapflow.llm import prefix_trie as m

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string"


def rebuilt_lists(rows):
    own = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            role, text = r.role or "", r.text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:m.WIDTH]
            own[r.conv_id].append(((r.turn is not None, r.turn or 0), digest, role, text))
    lists = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in lists.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = lists.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute_force(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children[p]
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        saved[p] = sum(saved[x] for x in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in cs if len(convs[c]) == len(p)))).encode()).hexdigest())
                  for p, cs in members.items())


def result(df):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                   r.ends_sha256) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def random_rows(seed, convs, words, longest):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "assistant"]), "é" * rnd.randrange(words) + "x")
            for c in range(convs) for t in range(rnd.randrange(longest))]


EDGE_ROWS = [
    (0, 0, "user", "hello"), (0, 1, "assistant", "hi"), (1, None, "user", "first"), (1, 0, "user", "second"),
    (1, 0, "user", "second"), (1, 0, None, "second"), (2, 0, None, None), (2, 1, "", ""), (3, 3, "user", "w " * 60_000),
    (5, 0, "user", "hello"), (6, 0, "user", "hello"), (7, 0, "user", "hello"), (None, 0, "user", "lost"), (11, 0, "a", "b"),
]


@pytest.mark.parametrize("block", [1, 3, 20_000])
@pytest.mark.parametrize("rows", [EDGE_ROWS, random_rows(1, 60, 2, 12), random_rows(2, 40, 1, 25)])
def test_forest_in_blocks(prepared, monkeypatch, rows, block):
    """The same trie whatever the blocks: the function that tasks run."""
    convs = rebuilt_lists([r for r in table(prepared, rows).collect()])
    digest = lambda t: hashlib.sha256(repr(t).encode()).hexdigest()[:m.WIDTH]      # noqa: E731
    lined = sorted((("".join(map(digest, turns))), c, [len(t[1].encode()) for t in turns]) for c, turns in convs.items())
    pieces = [lined[i:i + 7] for i in range(0, len(lined), 7)]
    done, spines = [], []
    for piece in pieces:
        forest = []
        for i in range(0, len(piece), block):
            new = [m.Hanging(k, s, 1, c) for k, c, s in piece[i:i + block]]
            new[0].first = i == 0
            for r in forest:
                r.last = False
            new[-1].last = True
            closed, forest = m.grow(forest + new)
            done += closed
        spines.append(forest)
    while True:
        final = len(spines) <= 2
        groups = [spines[i:i + 2] for i in range(0, len(spines), 2)]
        spines = []
        for g in groups:
            for s, side in [(s, side) for s in range(len(g)) for side in ("first", "last")]:
                for r in g[s]:
                    if (side == "first" and s > 0) or (side == "last" and s < len(g) - 1):
                        setattr(r, side, False)
            closed, kept = m.grow([r for s in g for r in s], final)
            done += closed
            spines.append(kept)
        if final:
            break
    low = {r["node_key"]: r["conv_id"] for r in done if r["was_open"]}
    got = sorted((r["conv_id"], r["depth"], low[r["parent_key"]] if r.get("parent_key") else r.get("parent_conv_id"),
                  r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in done)
    assert got == [r[:-1] for r in brute_force(convs)]


@pytest.mark.parametrize("rows", [EDGE_ROWS, random_rows(3, 150, 2, 12)])
def test_against_all_prefixes(prepared, rows):
    df = table(prepared, rows).repartition(4)
    assert result(m.conversation_trie(df)) == brute_force(rebuilt_lists(df.collect()))


def test_hot_opening_and_copies_over_many_partitions(prepared):
    """A third opens alike, a third is one conversation; more partitions than
    one call merges."""
    rows = [(c, t, "user", "same" if c % 3 == 0 or t == 0 and c % 3 == 1 else f"{c} {t}") for c in range(400) for t in range(4)]
    prepared.conf.set("spark.sql.shuffle.partitions", "40")
    prepared.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = table(prepared, rows)
        got = result(m.conversation_trie(df))
    finally:
        prepared.conf.set("spark.sql.shuffle.partitions", "3")
        prepared.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute_force(rebuilt_lists(df.collect()))


def test_empty(prepared):
    assert m.conversation_trie(table(prepared, [])).count() == 0


def test_ids_of_a_key_come_in_several_texts():
    import pyarrow as pa
    batch = lambda rows: pa.RecordBatch.from_pydict({"node_key": [r[0] for r in rows], "ids": [r[1] for r in rows]})     # noqa: E731
    out = list(m._ids_digest(iter([batch([("a", "1,2"), ("a", "3")]), batch([]), batch([("a", "11"), ("b", "-4")])])))
    got = {k: v for b in out for k, v in zip(*(c.to_pylist() for c in b.columns))}
    assert got == {"a": hashlib.sha256(b"1,2,3,11").hexdigest(), "b": hashlib.sha256(b"-4").hexdigest()}
