"""Hand-computed fixtures for loading, encoding, scaling, outliers and selection."""

import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fernwood.operators import audit, encode, outlier, select as sel
from fernwood.schema import COLUMN_NAMES, FEATURE_NAMES, LABELS, compose_label_dim, dictionary_frames
from fernwood.session import scratch_path
from fernwood.sources.csv_scan import check_columns, scan_headerless_csv


def _conn_sample(spark):
    # fixed values of the ported fixture
    cols = {
        "duration": [0, 1, 2, 3, 4, 5, 6, 7],
        "protocol_type": ["tcp", "udp", "icmp", "tcp", "udp", "icmp", "tcp", "udp"],
        "service": ["http", "telnet", "ftp", "http", "smtp", "domain_u", "http", "telnet"],
        "flag": ["SF", "S0", "REJ", "SF", "RSTR", "S0", "SF", "RSTO"],
        "src_bytes": [100, 200, 0, 50, 300, 0, 150, 250],
        "dst_bytes": [0, 500, 0, 100, 200, 0, 50, 300],
        "label": ["normal", "neptune", "normal", "satan", "neptune", "normal", "portsweep", "neptune"],
        "difficulty": [21] * 8,
    }
    rows = list(zip(*cols.values()))
    return spark.createDataFrame(rows, "duration int, protocol_type string, service string, flag string, "
                                       "src_bytes int, dst_bytes int, label string, difficulty int")


def test_column_contract():
    assert len(FEATURE_NAMES) == 41
    assert len(COLUMN_NAMES) == 43 and COLUMN_NAMES[-2:] == ["label", "difficulty"]


def test_headerless_csv_scan(spark):
    path = scratch_path(spark, "connections")
    row = ["0", "tcp", "http", "SF"] + ["1"] * 37 + ["normal", "20"]
    spark.createDataFrame([tuple(row)] * 3, [f"c{i}" for i in range(43)]).write.csv(path)
    df = scan_headerless_csv(spark, path)
    check_columns(df)
    assert df.count() == 3
    assert df.schema["src_bytes"].dataType.typeName() == "long"


def test_missing_file_names_path(spark):
    with pytest.raises(AnalysisException, match="no_such_file"):
        scan_headerless_csv(spark, "/tmp/no_such_file_xyz.txt").count()


def test_null_audit_warns(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "a")], "x double, s string")
    with pytest.warns(UserWarning):
        n, cols = audit.check_missing(df)
    assert n == 2 and sorted(cols) == ["s", "x"]


def test_one_hot_levels(spark):
    df = _conn_sample(spark)
    levels = encode.fit_one_hot(df, ["protocol_type", "flag"])
    out = encode.one_hot(df, levels)
    assert len([c for c in out.columns if c.startswith("protocol_type_")]) == 3
    assert len([c for c in out.columns if c.startswith("flag_")]) == 5
    assert "protocol_type" not in out.columns
    assert out.schema["flag_SF"].dataType.typeName() == "byte"


def test_unseen_service_gets_appended_id(spark):
    df = _conn_sample(spark)
    vocab = encode.fit_vocabulary(df, ["service"])
    n_known = vocab.sizes["service"]
    test = spark.createDataFrame([("http",), ("zzz_new",), ("aaa_new",)], "service string")
    out, new_vocab = encode.ordinal_transform(test, vocab, ["service"])
    ids = {r["service"] for r in out.collect()}
    got = dict(zip(["http", "zzz_new", "aaa_new"], [r["service"] for r in out.orderBy(F.lit(1)).collect()]))
    assert vocab.sizes["service"] == n_known  # input vocabulary unchanged
    assert new_vocab.sizes["service"] == n_known + 2
    assert min(i for i in ids if i is not None) >= 0
    new_ids = sorted(r["id"] for r in new_vocab.table.where(F.col("value").isin("zzz_new", "aaa_new")).collect())
    assert new_ids == [n_known, n_known + 1]
    aaa = new_vocab.table.where(F.col("value") == "aaa_new").first()["id"]
    assert aaa == n_known  # sorted among the new values
    assert got


def test_standardize_population_std(spark):
    fit = spark.createDataFrame([(1.0, 10.0), (2.0, 20.0), (3.0, 30.0), (4.0, 40.0)], "a double, b double")
    sc = encode.fit_scaler(fit)
    z = sc.transform(fit).agg(F.avg("a"), F.stddev_pop("a"), F.avg("b"), F.stddev_pop("b")).first()
    assert abs(z[0]) < 1e-6 and abs(z[1] - 1) < 1e-6 and abs(z[2]) < 1e-6 and abs(z[3] - 1) < 1e-6
    test = spark.createDataFrame([(5.0, 50.0), (6.0, 60.0)], "a double, b double")
    assert sc.transform(test).agg(F.avg("a")).first()[0] > 0


def test_scaler_zero_std_divides_by_one(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "c double")
    assert [r[0] for r in encode.fit_scaler(df).transform(df).collect()] == [0.0, 0.0]


def test_labels(spark):
    lab = spark.createDataFrame([("normal",), ("neptune",), ("normal",), ("smurf",), ("satan",)], "label string")
    y = [r["y"] for r in encode.make_labels(lab, "binary").collect()]
    assert sorted(y) == [0, 0, 1, 1, 1]
    names, cats = dictionary_frames(spark)
    dim = compose_label_dim(names, cats)
    multi = spark.createDataFrame([(n,) for n in ["normal", "neptune", "smurf", "satan", "ipsweep", "back"]],
                                  "label string")
    ids = [r["y"] for r in encode.make_labels(multi, "multiclass", label_dim=dim).collect()]
    assert len(set(ids)) == 6 and min(ids) >= 0
    cat = {r["label"]: r["y"] for r in encode.make_labels(multi, "multiclass_5cat", label_dim=dim).collect()}
    assert cat["normal"] == 1 and cat["neptune"] == 0 and cat["satan"] == 2


def test_unknown_task_and_label(spark):
    lab = spark.createDataFrame([("nope",)], "label string")
    with pytest.raises(ValueError):
        encode.make_labels(lab, "ternary")
    names, cats = dictionary_frames(spark)
    with pytest.raises(Exception, match="label not in dictionary"):
        encode.make_labels(lab, "multiclass", label_dim=compose_label_dim(names, cats)).collect()


def test_dictionary_categories():
    counts = {}
    for _, _, c in LABELS:
        counts[c] = counts.get(c, 0) + 1
    assert counts == {"R2L": 15, "DoS": 11, "U2R": 7, "Probe": 6, "Normal": 1}


def _outlier_frame(spark):
    rows = list(zip(range(1, 11), [1, 2, 3, 4, 5, 6, 7, 8, 9, -100], [1, 2, 3, 4, 5, 6, 7, 8, 9, 1000],
                    [0, 1, 0, 1, 0, 1, 0, 1, 0, 1]))
    return spark.createDataFrame(rows, "normal_col int, with_outlier_low int, with_outlier_high int, onehot_col int")


def test_outlier_counts(spark):
    df = _outlier_frame(spark)
    rep = {r["feature"]: r["n_outliers"] for r in
           outlier.detect_outliers_iqr(df, ["normal_col", "with_outlier_high", "missing"]).collect()}
    assert rep["normal_col"] == 0 and rep["with_outlier_high"] >= 1 and rep["missing"] == 0
    s = spark.createDataFrame([("a",), ("b",), ("c",)], "str_col string")
    assert outlier.detect_outliers_iqr(s, ["str_col"]).first()["n_outliers"] == 0


def test_quantiles_match_linear_interpolation(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 9, 1000]], "v double")
    q = outlier.fit_bounds(df, ["v"]).fences["v"]
    assert q[0] == 3.25 and q[1] == 7.75


def test_clip_keeps_rows(spark):
    df = _outlier_frame(spark)
    b = outlier.fit_bounds(df, ["with_outlier_high"])
    out = outlier.clip(df, b)
    assert out.count() == 10
    assert out.agg(F.max("with_outlier_high")).first()[0] < 1000
    assert out.where(F.col("with_outlier_high").isNull()).count() == 0


def test_log1p(spark):
    df = spark.createDataFrame([(0,), (100,), (10000,)], "src_bytes int")
    out = outlier.log1p_append(df, ["src_bytes"])
    assert "src_bytes" in out.columns and "src_bytes_log1p" in out.columns
    assert out.first()["src_bytes_log1p"] == 0.0


def test_outlier_pipeline(spark):
    df = _outlier_frame(spark)
    out, counts, _ = outlier.outlier_pipeline(df, ["normal_col", "with_outlier_high"], ["with_outlier_high"])
    assert "with_outlier_high_log1p" in out.columns and out.count() == 10
    assert {r["feature"] for r in counts.collect()} == {"normal_col", "with_outlier_high"}
    assert set(outlier.LONG_TAIL_COLUMNS) == {"src_bytes", "dst_bytes", "count", "srv_count"}


def test_variance_filter_and_top_k(spark):
    rows = [(float(i % 7), float(i % 3), 5.0, 1 if i == 0 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, constant double, near_constant int")
    kept = sel.variance_filter(df)
    assert kept == ["a", "b"]
    rank = spark.createDataFrame([(0, "a", 0.5), (1, "b", 0.3), (2, "c", 0.2)],
                                 "position int, feature string, importance double")
    assert [r["feature"] for r in sel.top_k(rank, 2).collect()] == ["a", "b"]
    assert len(sel.top_k(rank, 10).collect()) == 3


def test_histogram_fills_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (10.0,)], "x double")
    h = audit.histogram(df, ["x"], bins=5).orderBy("bin").collect()
    assert [r["n"] for r in h] == [2, 0, 0, 0, 1]
    assert math.isclose(h[-1]["hi"], 10.0)
