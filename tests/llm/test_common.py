import random

from fareflow.llm.common import connected_components, merged_components


def plain(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return sorted((x, root(x)) for x in up)


def frame(spark, edges):
    return spark.createDataFrame(edges, "a long, b long")


def test_components_grow_by_edges(spark):
    r = random.Random(4)
    for nodes in (12, 300):
        batches = [[(r.randrange(nodes), r.randrange(nodes)) for _ in range(nodes // 6)] for _ in range(4)]
        batches.insert(2, [])
        batches.append([(k, k + 1) for k in range(nodes, nodes + 70)] + [(0, nodes + 70), (5, 5)])
        groups, seen = connected_components(frame(spark, batches[0]), "t"), list(batches[0])
        for batch in batches[1:]:
            groups = merged_components(groups, frame(spark, batch), "t")
            seen += batch
            assert sorted(map(tuple, groups.select("node", "component").collect())) == plain(seen)
