"""What the operators leave on the driver."""

from linkloom.llm import common, components, simhash


def test_components_let_go_of_each_round(spark, monkeypatch):
    """A chain takes several rounds; the driver's heap is collected after each."""
    rounds, let_go, write = [], [], common.written
    monkeypatch.setattr(common, "written", lambda df, name, *a: rounds.append(name) or write(df, name, *a))
    monkeypatch.setattr(common, "release", lambda _: let_go.append(1))
    got = components.components(spark.createDataFrame([(i, i + 1) for i in range(12)], "a long, b long"))
    assert {r["root"] for r in got.collect()} == {0} and got.count() == 13
    assert len(let_go) == rounds.count("star") > 2


def test_cross_links_let_go_between_their_steps(spark, monkeypatch):
    """Fingerprints of one key in two components: the links across are found, and the heap is collected between the steps."""
    let_go = []
    monkeypatch.setattr(common, "release", lambda _: let_go.append(1))
    monkeypatch.setattr(simhash, "components", lambda edges: edges.sparkSession.createDataFrame([], "node struct<nameless:boolean,doc_id:long,tie:long>, root struct<nameless:boolean,doc_id:long,tie:long>"))
    fps = spark.createDataFrame([(1, 0, [0b111 << 32]), (2, 0, [0b111 << 35]), (3, 0, [0b111 << 38])], "doc_id long, __tie long, fps array<long>")
    groups, _ = simhash._searched(fps, 1)
    assert groups.count() == 3 and len(let_go) >= 2
