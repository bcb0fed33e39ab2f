import duckdb
import pytest

from barloom.llm.mixing import MIX_SQL, mix_sources, source_targets

SCHEMA = "doc_id long, text string, source string, size string"


def reference_targets(sizes, share=1.5, most=2, weights=(3, 1, 2)):
    keys = sorted(sizes)
    w = {k: weights[i % len(weights)] for i, k in enumerate(keys)}
    budget, out, live = share * sum(sizes.values()), {}, set(keys)
    while live:
        level = budget / sum(w[k] for k in live)
        over = {k for k in live if most * sizes[k] <= w[k] * level}
        if not over:
            return out | {k: w[k] * level for k in live}
        out |= {k: float(most * sizes[k]) for k in over}
        budget -= sum(most * sizes[k] for k in over)
        live -= over
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 500, "d": 0}, {"x": 7}, {f"s{i}": i * i for i in range(1, 12)}])
def test_targets_match_repeated_sharing(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "key string, size long")
    got = {r.key: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(reference_targets(sizes))


def rows():
    out = [(i, "w " * ((i * 37) % 90 + 1), ["a", "b", "c", None][0 if i % 3 else i % 4], "x") for i in range(900)]
    return out + [(None, "n n", "b", None), (5, "again", "c", None), (5, "again", "c", None), (2000, None, "a", None), (2001, "", "zero", None), (2002, "\x0b \t\n", None, None)]


def test_words_come_near_target_and_match_sql(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = mix_sources(df).toPandas()
    assert len(got) == len(rows())
    assert (got.taken <= 2 * got["size"]).all()
    for _, part in got.groupby(got.source.fillna("~")):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 2 * part["size"].max()
        assert part.source_size.iloc[0] == part["size"].sum()
    con = duckdb.connect()
    documents = df.toArrow()
    con.register("documents", documents)
    want = con.execute(MIX_SQL + " ORDER BY ALL").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in mix_sources(df).collect())
    again = mix_sources(df.repartition(3)).toPandas()
    assert sorted(again.taken) == sorted(got.taken)


def test_empty_table(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
