"""Sources: declared indicator schemas against the reference's schema dumps, reading rules."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from fixtures import write_indicator_files
from statlens.operators.profile import schema_report, summary_strings
from statlens.sources.indicator import SCHEMAS, read_indicator
from statlens.sources.tables import read_table

# The reference's printSchema output for the three files.
GOLDEN = {
    "ladder": """root
 |-- Entity: string (nullable = true)
 |-- Code: string (nullable = true)
 |-- Year: integer (nullable = true)
 |-- Cantril ladder score: double (nullable = true)
""",
    "poverty_life": """root
 |-- Entity: string (nullable = true)
 |-- Code: string (nullable = true)
 |-- Year: integer (nullable = true)
 |-- Life expectancy - Sex: all - Age: 0 - Variant: estimates: double (nullable = true)
 |-- $2.15 a day - Share of population in poverty: double (nullable = true)
 |-- 990305-annotations: string (nullable = true)
 |-- Population (historical): long (nullable = true)
 |-- World regions according to OWID: string (nullable = true)
""",
    "corruption": """root
 |-- Entity: string (nullable = true)
 |-- Code: string (nullable = true)
 |-- Year: integer (nullable = true)
 |-- Political corruption index (best estimate, aggregate: average): double (nullable = true)
""",
}


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    ladder, poverty, corruption = write_indicator_files(str(tmp_path_factory.mktemp("src")))
    return {"ladder": ladder, "poverty_life": poverty, "corruption": corruption}


@pytest.mark.parametrize("name", list(GOLDEN))
def test_declared_schema_matches_golden(spark, paths, name):
    df = read_indicator(spark, paths[name], name)
    assert df.schema.treeString() == GOLDEN[name]
    assert df.count() > 0


def test_inferred_schema_is_opt_in(spark, paths):
    with pytest.raises(ValueError):
        read_indicator(spark, paths["ladder"])
    inferred = read_indicator(spark, paths["poverty_life"], infer=True)
    types = dict(inferred.dtypes)
    assert types["Year"] == "int" and types["Population (historical)"] == "bigint"
    assert types["$2.15 a day - Share of population in poverty"] == "double"


def test_bad_row_fails_fast(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("Entity,Code,Year,Cantril ladder score\nA,AAA,not-a-year,1.0\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_indicator(spark, str(p), SCHEMAS["ladder"]).collect()


def test_schema_report_and_summary(spark, paths):
    df = read_indicator(spark, paths["ladder"], "ladder")
    rep = {r["column_name"]: (r["position"], r["data_type"], r["nullable"], r["non_null"])
           for r in schema_report(df).collect()}
    n = df.count()
    assert rep["Year"] == (3, "int", True, n)
    assert rep["Cantril ladder score"][3] == n - 1      # one empty score
    summ = {r["summary"]: r for r in summary_strings(df, ["Cantril ladder score"]).collect()}
    assert set(summ) == {"count", "mean", "stddev", "min", "25%", "50%", "75%", "max"}


def test_read_table_hides_internal_id(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("x", 1)], "_id string, v int").write.parquet(path)
    assert read_table(spark, path).columns == ["v"]
    assert read_table(spark, path, hide_internal_id=False).columns == ["_id", "v"]
