"""From buckets to components: which pairs are asked."""

from itertools import combinations

from salesloom.llm.buckets import FEW, linked_components, prefix_pairs, shared_buckets


def _asked(spark, rows, links, sets):
    """The passes' pairs, the nodes of the last pass, and the components found."""
    asked, late = [], []
    shared = shared_buckets(spark.createDataFrame(rows, "bucket long, node long, size int"))
    known = spark.createDataFrame(sorted(links) or [(-1, -1)], "a long, b long")

    def confirm(pairs):
        asked.append({(r.a, r.b) for r in pairs.collect()})
        return pairs.join(known, ["a", "b"])

    def last(members):
        late.append({r.node for r in members.collect()})
        return prefix_pairs(members, 75, sets, 1)

    found = linked_components(shared, confirm, 50, hub_rounds=1, last=last)
    return asked, late[0], {r.node: r.component for r in found.collect()}


def _sets(spark, elements):
    rows = [(node, len(own), [0], own) for node, own in elements.items()]
    return spark.createDataFrame(rows, "node long, n int, sketch array<long>, elements array<long>")


def test_a_pair_that_was_rejected_is_not_asked_by_rare_elements(spark):
    """Buckets of two and their one pair; all sets are alike, so that the rare elements would give every pair."""
    rows = [(bucket, 2 * bucket + side, 10) for bucket in range(1, 6) for side in (0, 1)]
    nodes = [node for _, node, _ in rows]
    asked, late, found = _asked(spark, rows, {(2, 3)}, _sets(spark, {node: list(range(10)) for node in nodes}))
    assert asked[0] == {(2 * bucket, 2 * bucket + 1) for bucket in range(1, 6)}
    assert late == set()
    assert asked[-1] == set()
    assert found == {2: 2, 3: 2}


def test_every_pair_of_a_bucket_is_asked_once_components_are_open(spark):
    """Small and large buckets, and one whose smallest node has a size that keeps it from meeting the others."""
    small, large, apart = range(10, 14), range(100, 104 + 2 * FEW), (200, 201)
    rows = [(1, n, 10) for n in small] + [(2, n, 10) for n in large] + [(3, 200, 100), (3, 201, 10)]
    wanted = {p for group in (small, large) for p in combinations(group, 2)} | {apart}
    sets = _sets(spark, {n: list(range(10)) for _, n, _ in rows})
    asked, late, found = _asked(spark, rows, {(12, 13), (109, 110), apart}, sets)
    assert wanted <= set().union(*asked)
    assert late == set(large[1:])
    assert found == {12: 12, 13: 12, 109: 109, 110: 109, 200: 200, 201: 200}
