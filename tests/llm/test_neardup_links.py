from spindrift.llm import neardup
from spindrift.plans import components


def test_few_links_take_no_rounds(spark, monkeypatch):
    """Each round of stars is several shuffles, which is most of the time where links are few."""
    words = [f"w{i}" for i in range(60)]
    near = [(k, " ".join([*words[:59], f"x{k}"])) for k in range(6)]
    df = spark.createDataFrame([*near, (9, " ".join(reversed(words))), (None, "a"), (4, near[4][1])], "doc_id long, text string")
    rounds = []
    state = components._state
    monkeypatch.setattr(components, "_state", lambda *a: rounds.append(1) or state(*a))
    want = sorted([(k, k, 0) for k in range(6)] + [(9, 9, 9)])
    assert sorted(map(tuple, neardup.near_duplicates(df).collect())) == want
    assert not rounds
    monkeypatch.setattr(neardup, "LINKS_AT_ONCE", 0)
    assert sorted(map(tuple, neardup.near_duplicates(df).collect())) == want
    assert rounds
