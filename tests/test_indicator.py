"""Indicator analysis on the synthetic indicator files, against a pandas brute force.

The brute force follows the reference's steps literally (pandas masks,
numpy medians and quantiles) on the same rows; the Spark results must agree.
"""

import math

import numpy as np
import pandas as pd
import pytest

from fixtures import (
    CORRUPTION, CORRUPTION_HEADER, LADDER, LADDER_HEADER, POVERTY_HEADER, POVERTY_LIFE, write_indicator_files,
)
from statlens.functions.columns import override_value, rename_checked
from statlens.operators import clean
from statlens.operators.clean import CONTINENTS, INCOME_GROUPS
from statlens.operators.profile import profile
from statlens.plans.analysis import indicator_analysis

LIFE, POV, POP = "Life expectancy", "Share in extreme poverty", "Population"
LAD, COR = "Cantril ladder score", "Political corruption index"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    paths = write_indicator_files(str(tmp_path_factory.mktemp("indicators")))
    return indicator_analysis(spark, *paths, year=2021)


def _pd(rows, header):
    return pd.DataFrame(rows, columns=header).astype({"Year": int})


@pytest.fixture(scope="module")
def brute():
    lad = _pd(LADDER, LADDER_HEADER)[["Entity", "Year", LAD]].rename(columns={"Entity": "Country"})
    lad = lad[lad.Year == 2021].dropna()
    lad = lad[~lad.Country.isin(INCOME_GROUPS)]
    lad_cont = lad[lad.Country.isin(CONTINENTS)]
    lad = lad[(~lad.Country.isin(CONTINENTS)) | (lad.Country == "Australia")]
    pov = _pd(POVERTY_LIFE, POVERTY_HEADER)
    pov = pov[["Entity", "Year", POVERTY_HEADER[3], POVERTY_HEADER[4], POVERTY_HEADER[6]]]
    pov.columns = ["Country", "Year", LIFE, POV, POP]
    pov = pov[pov.Year == 2021].dropna()
    pov = pov[pov.Country != "World"].copy()
    pov.loc[pov.Country == "Central African Republic", LIFE] = 52.31
    cor = _pd(CORRUPTION, CORRUPTION_HEADER)[["Entity", "Year", CORRUPTION_HEADER[3]]]
    cor.columns = ["Country", "Year", COR]
    cor = cor[cor.Year == 2021].dropna()
    cor = cor[cor.Country != "World"]
    cor_cont = cor[cor.Country.isin(CONTINENTS)]
    cor = cor[(~cor.Country.isin(CONTINENTS)) | (cor.Country == "Australia")]
    j = lad.merge(cor.drop(columns=["Year"]), on="Country")
    return {"ladder": lad, "ladder_continents": lad_cont, "poverty_life": pov, "corruption": cor,
            "corruption_continents": cor_cont, "joined": j}


def _names(df, col="Country"):
    return sorted(r[col] for r in df.select(col).collect())


@pytest.mark.parametrize("name", ["ladder", "ladder_continents", "poverty_life", "corruption",
                                  "corruption_continents", "joined"])
def test_cleaned_frames(results, brute, name):
    got = results[name].toPandas()
    exp = brute[name]
    assert sorted(got.columns) == sorted(exp.columns)
    key = sorted(got.columns)
    g = got[key].sort_values("Country").reset_index(drop=True)
    e = exp[key].sort_values("Country").reset_index(drop=True)
    pd.testing.assert_frame_equal(g, e, check_dtype=False)


def test_cleaning_edges(results):
    ladder = _names(results["ladder"])
    assert "Oldland" not in ladder                       # year filter (F1)
    assert "Nanland" not in ladder and "Nullland" not in ladder   # NaN and NULL dropped (F2)
    assert not set(INCOME_GROUPS) & set(ladder)           # group labels (F3)
    assert "Australia" in ladder and "Africa" not in ladder       # F6 keeps Australia
    assert "Australia" in _names(results["ladder_continents"])    # F5 too (Q4)
    pov = _names(results["poverty_life"])
    assert "Nopop" not in pov and "World" not in pov
    assert "Africa" in pov                                # poverty frame drops only World (Q3)
    car = results["poverty_life"].where("Country = 'Central African Republic'").first()
    assert car[LIFE] == 52.31                             # P4


def test_bands_share_edges(results):
    low, mid, high = (set(_names(results[f"poverty_band_{b}"], "label")) for b in ("low", "middle", "high"))
    assert "Borduria" in low and "Borduria" in mid        # 0.5 in both (Q1)
    assert "Carpania" in mid and "Carpania" in high       # 5.0 in both
    bands = results["corruption_bands"].toPandas()
    assert sorted(bands[bands.label == "Borduria"].band) == ["high", "low"]   # 0.3 in both


def test_bubble_sizes(results, brute):
    b = {r["label"]: r["size"] for r in results["poverty_band_low"].collect()}
    pov = brute["poverty_life"]
    exp = {r.Country: r.Population / 200000 for r in pov[pov[POV] <= 0.5].itertuples()}
    assert b == pytest.approx(exp)


def test_medians_and_means(results, brute):
    pov = brute["poverty_life"]
    ml, mp = np.median(pov[LIFE]), np.median(pov[POV])
    exp = sorted(pov[(pov[LIFE] > ml) & (pov[POV] > mp)].Country)
    assert _names(results["above_medians"]) == exp
    rep = results["above_medians_report"].first()
    assert rep["n"] == len(exp) and rep["names"] == ", ".join(exp)
    al, ap = np.mean(pov[LIFE]), np.mean(pov[POV])
    assert _names(results["above_means"]) == sorted(pov[(pov[LIFE] > al) & (pov[POV] > ap)].Country)


def test_lower_quartile_inclusive_and_lines(results, brute):
    pov = brute["poverty_life"]
    q = pov[POV].quantile(0.25)
    exp = sorted(pov[pov[POV] <= q].Country)
    assert _names(results["low_poverty"]) == exp
    lines = results["low_poverty_lines"].collect()
    assert sorted(r["label"] for r in lines) == exp
    assert lines[0]["p75"] == pytest.approx(np.quantile(pov[LIFE], 0.75), abs=0, rel=1e-15)
    assert lines[0]["p25"] == pytest.approx(np.quantile(pov[LIFE], 0.25), abs=0, rel=1e-15)
    assert lines[0]["mean"] == pytest.approx(np.mean(pov[LIFE]), rel=1e-12)


def test_quartiles_on_joined(results, brute):
    j = brute["joined"]
    q25, q75 = np.quantile(j[COR], 0.25), np.quantile(j[COR], 0.75)
    assert _names(results["low_corruption"]) == sorted(j[j[COR] <= q25].Country)
    high = j[j[COR] >= q75]
    assert _names(results["high_corruption"]) == sorted(high.Country)
    exp = sorted(high[high[LAD] > np.mean(j[LAD])].Country)
    assert _names(results["high_corruption_high_ladder"]) == exp
    assert _names(results["high_corruption_high_ladder_head"]) == exp[:9]


def test_join_is_inner(results):
    names = _names(results["joined"])
    assert "Ladderonly" not in names and "Corruptonly" not in names
    assert results["joined"].columns.count("Country") == 1 and results["joined"].columns.count("Year") == 1


def test_top_k_tie_break(results, brute):
    j = brute["joined"].sort_values([LAD, "Country"], ascending=[False, True])
    got = [(r["label"], r["value"]) for r in results["top_10_ladder"].collect()]
    assert got == list(zip(j.Country.head(10), j[LAD].head(10)))
    assert ("Carpania", 5.0) in got and ("Kaldor", 5.0) not in got   # tie at 10th broken by name
    j2 = brute["joined"].sort_values([COR, "Country"], ascending=[False, True])
    got2 = [r["label"] for r in results["top_20_corruption"].collect()]
    assert got2 == list(j2.Country.head(20))


def test_continent_comparison(results, brute):
    rows = results["continents"].orderBy("position", "series").collect()
    assert len(rows) == 2 * len(CONTINENTS)
    by = {(r["label"], r["series"]): r["value"] for r in rows}
    assert by[("South America", "Political corruption index x10")] is None   # missing row -> NULL (Q5)
    assert by[("Africa", "Political corruption index x10")] == pytest.approx(6.0)
    assert by[("Australia", LAD)] == 7.0
    assert [r["label"] for r in rows[::2]] == CONTINENTS


def test_profiles(results, brute):
    prof = {(r["column_name"], r["statistic"]): r["value"] for r in results["poverty_profile"].collect()}
    pov = brute["poverty_life"]
    assert prof[(LIFE, "count")] == len(pov)
    assert prof[(LIFE, "mean")] == pytest.approx(pov[LIFE].mean())
    assert prof[(LIFE, "stddev")] == pytest.approx(pov[LIFE].std(ddof=1))
    assert prof[(POV, "max")] == pov[POV].max()
    assert prof[(POV, "50%")] in set(pov[POV])     # approximate percentile is an element (Q18)
    texts = {(r["column_name"], r["statistic"]): r["text"] for r in results["poverty_profile"].collect()}
    assert prof[("Country", "count")] == len(pov)
    assert texts[("Country", "min")] == pov.Country.min() and texts[("Country", "max")] == pov.Country.max()
    assert ("Country", "mean") not in prof and texts[(LIFE, "min")] is None


def test_profile_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, None, None), (None, "", True)], "`a.b` double, s string, flag boolean")
    rows = {(r["column_name"], r["statistic"]): (r["value"], r["text"]) for r in profile(df).collect()}
    assert rows[("a.b", "count")] == (0.0, None) and rows[("a.b", "mean")] == (None, None)
    assert rows[("s", "count")] == (1.0, None) and rows[("s", "max")] == (None, "")
    assert not any(c == "flag" for c, _ in rows)          # summary() leaves it out too
    empty = {(r["column_name"], r["statistic"]): (r["value"], r["text"]) for r in profile(df.limit(0)).collect()}
    assert empty[("s", "count")] == (0.0, None) and empty[("s", "min")] == (None, None)
    assert profile(df.select("flag")).collect() == []


def test_rename_checked_and_quoting(spark):
    df = spark.createDataFrame([(1, 2.0)], "`a.b` int, `$2.15 x` double")
    assert rename_checked(df, {"a.b": "c"}).columns == ["c", "$2.15 x"]
    with pytest.raises(KeyError):
        rename_checked(df, {"missing": "x"})


def test_label_filters_with_frames(spark):
    df = spark.createDataFrame([("A", 1.0), ("World", 2.0), ("B", 3.0), (None, 4.0)], "Country string, v double")
    labels = spark.createDataFrame([("World",), ("B",)], "label string")
    assert _names(clean.exclude_groups(df, "Country", labels)) == ["A"]
    assert _names(clean.group_rows(df, "Country", labels)) == ["B", "World"]
    assert _names(clean.exclude_groups(df, "Country", ["World", "B"])) == ["A"]


def test_override_with_table(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "Country string, v double")
    fixes = spark.createDataFrame([("B", 9.5)], "k string, val double")
    got = {r["Country"]: r["v"] for r in override_value(df, "Country", "v", fixes).collect()}
    assert got == {"A": 1.0, "B": 9.5}
    got2 = {r["Country"]: r["v"] for r in override_value(df, "Country", "v", {"A": 0.5}).collect()}
    assert got2 == {"A": 0.5, "B": 2.0}
    nulls = spark.createDataFrame([("B", None), (None, 7.0), (None, 8.0)], "k string, val double")
    for fix in (nulls, {"B": None}):
        assert {r["Country"]: r["v"] for r in override_value(df, "Country", "v", fix).collect()} == {"A": 1.0, "B": None}
    with pytest.raises(Exception, match="correction listed twice: B"):
        override_value(df, "Country", "v", fixes.union(fixes)).collect()


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([("A", float("nan")), ("B", 1.0)], "Country string, v double")
    assert _names(clean.drop_nulls(df)) == ["B"]
    assert not math.isnan(clean.drop_nulls(df).first()["v"])


def test_every_result_runs(results):
    assert len(results) == 36
    for name, df in results.items():
        rows = df.collect()
        assert isinstance(rows, list), name
    assert {r["label"] for r in results["above_medians_bubbles"].collect()} == set(_names(results["above_medians"]))


def test_staged_frames_give_same_results(spark, tmp_path_factory, results):
    paths = write_indicator_files(str(tmp_path_factory.mktemp("indicators_staged")))
    staged = indicator_analysis(spark, *paths, year=2021, stage_dir="checkpoint")
    for name in ("joined", "above_medians_report", "top_10_ladder", "high_corruption_high_ladder", "continents"):
        a = sorted(tuple(r) for r in results[name].collect())
        b = sorted(tuple(r) for r in staged[name].collect())
        assert a == b, name
    plan = staged["joined"]._jdf.queryExecution().executedPlan().toString()
    assert "Format: Parquet" in plan and "Format: CSV" not in plan
    assert "statlens-analysis-" in plan     # staged under the session's spark.checkpoint.dir


def test_label_filter_literals(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 2), (0.30000000000000004, 3)], "v double, k int")
    assert [r["k"] for r in clean.group_rows(df, "v", [0.1, 0.1 + 0.2]).orderBy("k").collect()] == [1, 3]
    assert [r["k"] for r in clean.exclude_groups(df, "k", [2]).orderBy("k").collect()] == [1, 3]
    quoted = spark.createDataFrame([("it's",), ("a\\\\b",), ("x",)], "c string")
    assert _names(clean.group_rows(quoted, "c", ["it's", "a\\\\b"]), "c") == ["a\\\\b", "it's"]
