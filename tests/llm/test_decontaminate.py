import random

from tapflow.llm import decontaminate as m

ITEM = [f"bench{i}" for i in range(30)]


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"))


def flagged(spark, docs, items, **options):
    d, b = frames(spark, docs, items)
    return {r.doc_id: [x.item_id for x in r.matches] for r in m.find_overlaps(d, b, **options).collect()}


def test_substitutions_are_tolerated(prepared):
    rng = random.Random(2)
    docs, fill = [], lambda n: [f"f{rng.randrange(1 << 30)}" for _ in range(n)]
    for k in range(40):
        w = list(ITEM)
        for i in rng.sample(range(len(w)), 3):                  # one word in ten
            w[i] = f"sub{rng.randrange(1 << 30)}"
        docs.append((k, " ".join(fill(50) + w + fill(50))))
    docs += [(100 + k, " ".join(fill(200))) for k in range(40)]
    docs += [(200, " ".join(fill(9) + ITEM[:9] + fill(9))), (201, " ".join(fill(9) + ITEM[5:16] + fill(9)))]
    items = [(1, " ".join(ITEM)), (2, " ".join(fill(20)))]
    got = flagged(prepared, docs, items)
    assert all(got[k] == [1] for k in range(40)) and not any(got[100 + k] for k in range(40))
    assert got[200] == [] and got[201] == [1]                   # 9 and 11 equal words
    assert flagged(prepared, docs, items, block_entries=40) == got      # several blocks


def test_every_single_substitution_is_found(prepared):
    docs = [(i, " ".join(ITEM[:i] + ["zzz"] + ITEM[i + 1:])) for i in range(len(ITEM))]
    assert all(flagged(prepared, docs, [(7, " ".join(ITEM))]).values())


def brute(item, doc, diagonal):
    """Most equal words of a stretch on the diagonal with 80 % equal words."""
    same = [0 <= diagonal + k < len(doc) and doc[diagonal + k] == w for k, w in enumerate(item)]
    lo, hi = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    return max((sum(same[i:j]) for i in range(lo, hi) for j in range(i + 1, hi + 1)
                if 5 * sum(same[i:j]) >= 4 * (j - i)), default=0)


def substituted(rng, trials=400):
    """Items of 10 to 64 words inside documents, 5 to 20 % substituted."""
    for k in range(trials):
        item = [f"i{k}x{i}" for i in range(rng.randint(10, 64))]
        doc = list(item)
        for i in rng.sample(range(len(doc)), round(len(doc) * rng.uniform(0.05, 0.2))):
            doc[i] = f"s{rng.randrange(1 << 30)}"
        yield item, [f"f{rng.randrange(1 << 30)}" for _ in range(9)] + doc + ["end"] * 5


def test_overlap_equals_brute_force():
    hashes = m.WordHashes()
    for item, doc in substituted(random.Random(5)):
        block = m.Block([(1, " ".join(item))])
        for at, diagonal in block.hits(hashes.of(doc)):
            d, i, n, equal = block.overlap(hashes.of(doc), at, diagonal, 0.8)
            assert equal == brute(item, doc, diagonal) and 5 * equal >= 4 * n and d - i == diagonal
            assert equal == sum(a == b for a, b in zip(item[i:i + n], doc[d:d + n]))


def test_substituted_items_that_a_seed_hits_are_found(prepared):
    hashes, pairs = m.WordHashes(), list(substituted(random.Random(6)))
    fifth = [f"y{i}" for i in range(64)]
    pairs.append((fifth, [f"z{i}" if i % 5 == 4 else w for i, w in enumerate(fifth)]))
    want = {}
    for k, (item, doc) in enumerate(pairs):
        need = min(10, -(-4 * len(item) // 5))
        hits = m.Block([(k, " ".join(item))]).hits(hashes.of(doc))
        want[k] = [k] if any(brute(item, doc, d) >= need for _, d in hits) else []
    assert want[len(pairs) - 1]
    assert flagged(prepared, [(k, " ".join(d)) for k, (_, d) in enumerate(pairs)],
                   [(k, " ".join(i)) for k, (i, _) in enumerate(pairs)]) == want


def test_spans(prepared):
    d, b = frames(prepared, [(1, "a b c " + " ".join(ITEM).upper() + " d e")], [(5, " ".join(ITEM))])
    x = m.find_overlaps(d, b).first().matches[0]
    assert (x.item_id, x.doc_start, x.item_start, x.length, x.equal) == (5, 3, 0, 30, 30)


def test_short_items(prepared):
    docs = [(1, "say one two three four five six now"), (2, "one two three")]
    assert flagged(prepared, docs, [(1, "one two three four five six"), (2, "one two three"), (3, None)]) == {1: [1], 2: []}


def test_edges(prepared, docs, no_docs):
    none = prepared.createDataFrame([], "item_id long, text string")
    assert all(not r.matches for r in m.find_overlaps(docs, none).collect())
    item = prepared.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    kept = m.decontaminate(docs, item)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert m.decontaminate(no_docs, item).count() == 0
