import random
import re

import xxhash

from growthframe.llm.components import connected_components
from growthframe.llm.simhash import keep_one, near_duplicates


def brute(rows):
    """Fingerprints bit by bit, and components over all pairs."""
    prints = []
    for _, text, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        cut = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in cut]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    return sorted(((r[0], prints[k], least.get(find(k))) for k, r in enumerate(rows)), key=repr)


def corpus(n=150):
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(400)]
    rows = []
    for k in range(n):
        words = rng.choices(vocabulary, k=rng.randint(2, 60))
        rows.append((k, " ".join(words)))
        if k % 5 == 0:
            for copy in range(3):
                changed = [*words]
                changed[rng.randrange(len(words))] = rng.choice(vocabulary)
                rows.append((1000 + 10 * k + copy, (" ".join(changed)).upper()))
    return rows


def test_components_equal_brute_force(docs_of, odd):
    rows = corpus() + odd
    got = near_duplicates(docs_of(rows)).collect()
    assert sorted(((r["id"], r["fp"] % (1 << 64), r["component"]) for r in got), key=repr) == brute(rows)


def test_one_row_of_each_component_stays(docs_of, odd):
    rows = [(20_000 + k, t) for k, t in corpus(40)] + [r for r in odd if r[0] != 6]
    docs = docs_of(rows)
    left = keep_one(docs)
    assert left.schema == docs.schema
    found = near_duplicates(docs).collect()
    assert left.count() == len({(r["component"], r["fp"] if r["component"] is None else 0) for r in found})
    assert {r["doc_id"] for r in left.collect() if r["doc_id"] is not None} == {r["component"] for r in found if r["component"] is not None}


def test_empty_table(docs_of):
    assert near_duplicates(docs_of([])).count() == 0
    assert keep_one(docs_of([])).count() == 0


def test_components_of_a_long_path_a_hub_and_nulls(spark):
    path = [(k, k + 1) for k in range(300)]
    hub = [(1000, 1000 + k) for k in range(1, 200)]
    edges = spark.createDataFrame(path + hub + [(5, 5), (None, 7), (9999, 9998)], "u long, v long")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {**{k: 0 for k in range(301)}, **{1000 + k: 1000 for k in range(200)}, 9999: 9998, 9998: 9998}
