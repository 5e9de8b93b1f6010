from folio.llm.shared import connected_components, split_by_slots


def test_split_by_slots(spark):
    rows = spark.createDataFrame([(i if i % 50 else None, "x", i) for i in range(3000)], "k long, __other string, v long")
    wanted = spark.createDataFrame([(i,) for i in range(0, 3000, 7)] + [(None,)], "w long")
    maybe, sure = split_by_slots(rows, "k", wanted, "w")
    assert maybe.columns == sure.columns == rows.columns
    hits, rest = {r.v for r in maybe.collect()}, {r.v for r in sure.collect()}
    want = {i for i in range(0, 3000, 7) if i % 50}
    assert want <= hits and not hits & rest and len(hits) + len(rest) == 3000 and len(hits - want) < 30
    assert not {i for i in range(0, 3000, 50)} & hits
    none, every = split_by_slots(rows, "k", wanted.limit(0), "w")
    assert none.count() == 0 and every.count() == 3000


def test_components_of_a_hub(spark):
    edges = [(0, i) for i in range(1, 3000)] + [(5000 + i, 5001 + i) for i in range(40)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(3000)} | {5000 + i: 5000 for i in range(41)}
