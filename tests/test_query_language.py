import pytest

from quern.plans import query as Q


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, "One", 5, True, "x", ["a"]), (2, None, 0, False, "", []), (3, "one", None, None, "12", None), (4, "Two", 7, True, None, ["b"]), (5, "two", 7, False, "7", ["b"])]
    return spark.createDataFrame(data, "id int, category string, quality_score int, verified boolean, note string, tags array<string>")


def ids(result):
    return sorted(r["id"] for r in result.records.collect())


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("cat:ONE", [1, 3]),
        ("quality>=5", [1, 4, 5]),
        ("q!=7", [1, 2]),
        ('SELECT id WHERE category != "one"', [4, 5]),
        ("quality_score", [1, 4, 5]),
        ("verified", [1, 4]),
        ("note", [1, 3, 5]),
        ("tags", [1, 4, 5]),
        ("cat in (one, TWO)", [1, 3, 4, 5]),
        ("note>5", [3, 5]),
        ("verified:yes", [1, 4]),
        ("colour:red", []),
        ("", [1, 2, 3, 4, 5]),
        ("SELECT id WHERE quality_score > -1 AND verified = true", [1, 4]),
    ],
)
def test_conditions(rows, text, want):
    assert ids(Q.execute(text, rows)) == want


def test_nulls_first_on_ascending_and_last_on_descending(rows):
    up = [r["id"] for r in Q.execute("SELECT * ORDER BY quality_score ASC", rows, "id").records.collect()]
    down = [r["id"] for r in Q.execute("SELECT * ORDER BY quality_score DESC", rows, "id").records.collect()]
    assert up == [3, 2, 1, 4, 5] and down == [4, 5, 1, 2, 3]


def test_limit_offset_projection_and_groups(rows):
    r = Q.execute("SELECT id, colour GROUP BY category ORDER BY id LIMIT 2 OFFSET 1", rows, "id")
    assert [tuple(x) for x in r.records.collect()] == [(2, None), (3, None)]
    assert [tuple(x) for x in r.groups.collect()] == [("One", 1), ("Two", 1), ("one", 1), ("two", 1), ("unknown", 1)]


def test_aggregates_count_booleans_and_skip_strings(rows):
    r = Q.execute("SELECT COUNT(*), SUM(verified), AVG(quality_score), MAX(category)", rows).aggregations.first()
    assert tuple(r) == (5, 2, 4.75, 0)
    assert Q.execute('SELECT COUNT(*) WHERE cat = "one"', rows, compat=True).aggregations.first()[0] == 5
    assert Q.execute('SELECT COUNT(*) WHERE cat = "one"', rows).aggregations.first()[0] == 2


def test_errors(rows):
    for text in ("SELECT id WHERE a = ;", "SELECT id WHERE a OR b", "SELECT id LIMIT x"):
        with pytest.raises(Q.QueryError):
            Q.parse(text)
    with pytest.raises(Q.QueryError):
        Q.execute('SELECT * WHERE quality_score < "x"', rows)
    assert ids(Q.execute("SELECT id WHERE verified EXISTS OR note EXISTS", rows, compat=True)) == [1]
    assert Q.validate("foo:1", {"id"}) == ["unknown field foo"] and Q.validate("id:1", {"id"}) == []
    assert "id is 1" in Q.describe("id:1")
