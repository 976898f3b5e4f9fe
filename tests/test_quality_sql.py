"""Check kinds against plain SQL on random tables with NULL keys and duplicates."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quotewright.operators import quality as q
from quotewright.plans.runs import new_run

KEY = st.one_of(st.none(), st.integers(1, 3))
ROWS = st.lists(st.tuples(KEY, KEY, st.sampled_from(["agreed", "disagreed", None])), max_size=12)
PAIRS = st.lists(
    st.tuples(st.integers(1, 3), st.integers(1, 3), st.integers(0, 1), st.integers(1, 3)), max_size=8
)
MATCH = "x.k = y.k AND x.d = y.d"
SQL = {
    "unique": "SELECT count(*) FROM (SELECT k, d FROM a GROUP BY k, d HAVING count(*) > 1)",
    "unique_some": "SELECT count(*) FROM (SELECT k FROM a WHERE f = 'agreed' GROUP BY k HAVING count(*) > 1)",
    "fk": "SELECT count(*) FROM a x WHERE NOT EXISTS (SELECT 1 FROM b y WHERE x.k = y.k)",
    "fk_some": "SELECT count(*) FROM a x WHERE f = 'agreed' AND NOT EXISTS (SELECT 1 FROM b y WHERE x.k = y.k)",
    "join": "SELECT count(*) FROM a x JOIN b y ON x.k = y.k WHERE NOT (y.f = 'agreed')",
    "distinct": f"SELECT count(*) FROM (SELECT DISTINCT k, d FROM a) x WHERE NOT EXISTS (SELECT 1 FROM b y WHERE {MATCH})",
    "pair_count": "SELECT abs((SELECT coalesce(sum(pairs), 0) FROM p) - (SELECT count(*) FROM a WHERE f IN ('agreed', 'disagreed')))",
    "pair_flag": f"""SELECT coalesce(sum(x.pairs), 0) FROM p x JOIN a y ON {MATCH}
                     WHERE x.is_flagged <> CASE WHEN y.f = 'disagreed' THEN 1 ELSE 0 END""",
}
CHECKED = {
    "unique": "SELECT count(*) FROM a",
    "unique_some": "SELECT count(*) FROM a WHERE f = 'agreed'",
    "fk": "SELECT count(*) FROM a",
    "fk_some": "SELECT count(*) FROM a WHERE f = 'agreed'",
    "join": "SELECT count(*) FROM a",
    "distinct": "SELECT count(*) FROM (SELECT DISTINCT k, d FROM a)",
    "pair_count": "SELECT coalesce(sum(pairs), 0) FROM p",
    "pair_flag": "SELECT coalesce(sum(pairs), 0) FROM p",
}
K, KD = ("k",), ("k", "d")
CHECKS = [
    q.Unique("unique", "a", "error", "", keys=KD),
    q.Unique("unique_some", "a", "error", "", "f = 'agreed'", K),
    q.ForeignKey("fk", "a", "error", "", keys=K, parent="b"),
    q.ForeignKey("fk_some", "a", "error", "", "f = 'agreed'", K, "b"),
    q.JoinRule("join", "a", "error", "", keys=K, other="b", fails="not (f = 'agreed')"),
    q.DistinctForeignKey("distinct", "b", "error", "", keys=KD, child="a"),
    q.PairCount("pair_count", "a", "error", "", pairs="p", expected="f in ('agreed', 'disagreed')"),
    q.PairFlag("pair_flag", "a", "error", "", keys=KD, pairs="p", stored="f = 'disagreed'"),
]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=ROWS, b=ROWS, p=PAIRS)
def test_kinds_equal_sql(spark, a, b, p):
    con = duckdb.connect()
    tables = {}
    for name, rows, ddl in (
        ("a", a, "k int, d int, f string"), ("b", b, "k int, d int, f string"),
        ("p", p, "k int, d int, is_flagged int, pairs bigint"),
    ):
        tables[name] = spark.createDataFrame(rows, ddl)
        con.execute(f"CREATE TABLE {name} ({ddl.replace('string', 'varchar')})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    got = {r.check_name: (r.failing_count, r.checked_rows) for r in q.run_checks(CHECKS, tables, *new_run()).collect()}
    expected = {n: tuple(int(con.execute(s[n]).fetchone()[0]) for s in (SQL, CHECKED)) for n in SQL}
    assert got == expected


def test_checks_need_no_join(spark):
    tables = {n: spark.createDataFrame([], "k int, d int, f string") for n in "ab"}
    tables["p"] = spark.createDataFrame([], "k int, d int, is_flagged int, pairs bigint")
    plan = q.check_counts(CHECKS, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
