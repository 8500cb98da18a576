"""SimHash against its definition, links against all pairs, components against a search."""

import random
import re

import pytest
import xxhash

from tallyline.llm import simhash
from tallyline.llm.components import components


def fingerprint(text, size=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    ones = [sum(h >> b & 1 for h in hashes) for b in range(64)]
    value = sum(1 << b for b in range(64) if 2 * ones[b] > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def connected(nodes, linked):
    left, out = set(nodes), {}
    while left:
        root = min(left)
        seen, queue = {root}, [root]
        while queue:
            node = queue.pop()
            near = {n for n in left - seen if linked(node, n)}
            seen |= near
            queue += near
        out |= dict.fromkeys(seen, root)
        left -= seen
    return out


def near(a, b):
    return ((a ^ b) & (1 << 64) - 1).bit_count() <= simhash.MAX_BITS


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize(
    "text", [None, "", " \n", "a", "A b", "a b c", "Ä ä É", "a b c d a b c", "x " * 200_000]
)
def test_fingerprint_equals_its_definition(text):
    found = simhash.fingerprint(None if text is None else text.encode())
    assert found == fingerprint(text)


def random_groups(seed):
    """Fingerprints in chains, in a large ball and alone."""
    random.seed(seed)
    out = {0}
    for _ in range(15):
        value = random.getrandbits(64)
        for _ in range(random.randint(1, 6)):
            out.add(value)
            for _ in range(random.randint(1, 3)):
                value ^= 1 << random.randrange(64)
    centre = random.getrandbits(64)
    for _ in range(120):
        out.add(centre ^ 1 << random.randrange(64) ^ 1 << random.randrange(64))
    low = random.getrandbits(32)
    out |= {random.getrandbits(8) << 32 | low for _ in range(60)}
    return sorted(map(signed, out))


@pytest.mark.parametrize("seed", [1, 2])
def test_links_connect_what_all_pairs_connect(spark, seed):
    values = random_groups(seed)
    links = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"))
    pairs = [tuple(r) for r in links.collect()]
    assert all(a != b and near(a, b) for a, b in pairs)
    # No list of all pairs: a fingerprint is linked to at most 65 others in the second index.
    assert len(pairs) <= 65 * len(values)
    found = {r.node: r.root for r in components(links, "a", "b").collect()}
    expected = connected(values, near)
    for value in values:
        assert found.get(value, value) == expected[value]


def test_near_duplicates(documents, odd_rows):
    random.seed(4)
    base = [f"w{random.randrange(400)}" for _ in range(400)]
    rows = [*odd_rows, (50, " ".join(base))]
    for i in range(51, 80):
        copy = list(base)
        copy[random.randrange(400)] = "changed"
        rows.append((i, " ".join(copy)))
    found = simhash.near_duplicates(documents(rows)).collect()
    prints = {fingerprint(t) for _, t in rows}
    root = connected(sorted(prints), near)
    first = {}
    for i, text in rows:
        if i is not None:
            group = root[fingerprint(text)]
            first[group] = min(first.get(group, i), i)
    expected = [(i, fingerprint(t), first.get(root[fingerprint(t)])) for i, t in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_only_rows_without_id_have_no_component(documents):
    found = simhash.near_duplicates(documents([(None, "a b c d e")])).first()
    assert found.component_id is None


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(1_000, 1_000 + i) for i in range(1, 40)]
    links = spark.createDataFrame([*path, *star, (5, 5), (None, 3)], "a long, b long")
    found = {r.node: r.root for r in components(links, "a", "b").collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(1_000, 1_040), 1_000)}
