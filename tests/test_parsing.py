import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml.linalg import DenseVector, SparseVector
from pyspark.sql import functions as F

from tideline.functions import parsing as P


def test_label_csv(lines):
    row = P.parse_label_csv(lines("3.5,1,2,-4e1,,")).first()
    assert (row.label, row.features) == (3.5, DenseVector([1, 2, -40]))


def test_label_csv_bad_number_fails(lines):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        P.parse_label_csv(lines("3.5,x")).collect()


def test_label_space(lines):
    rows = P.parse_label_space(lines("0,1 0 0", "2,0 0 2")).collect()
    assert [(r.label, r.features) for r in rows] == [
        (0.0, DenseVector([1, 0, 0])), (2.0, DenseVector([0, 0, 2]))]


def test_keyed_csv_keeps_id_as_text(lines):
    row = P.parse_keyed_csv(lines("007,1.5,2")).first()
    assert (row.id, row.features) == ("007", DenseVector([1.5, 2]))


def test_clean_lines(lines):
    dirty = lines("  0 1:1  ", "", "# c", "\t# c", "1", " \t ", "\t1  2:3\r")
    assert [r.value for r in P.clean_lines(dirty).collect()] == ["0 1:1", "1", "1  2:3"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="a# \t\x01:1", max_size=8), min_size=1, max_size=12))
def test_clean_lines_as_trim(spark, texts):
    blank = "".join(map(chr, range(33)))
    expected = sorted(t.strip(blank) for t in texts
                      if t.strip(blank) and not t.strip(blank).startswith("#"))
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    assert sorted(r.value for r in P.clean_lines(df).collect()) == expected


def test_libsvm_edges_and_width(lines):
    df = P.parse_libsvm(lines("0 1:1.0 3:2.5", "1", "1  2:3"))
    assert [(r.label, r.indices, r["values"]) for r in df.collect()] == [
        (0.0, [0, 2], [1.0, 2.5]), (1.0, [], []), (1.0, [1], [3.0])]
    assert P.infer_width(df).first().width == 3
    assert P.infer_width(P.parse_libsvm(lines("1"))).first().width == 1


@pytest.mark.parametrize("line", ["1 2", "1 2:", "1 2:3:4", "x 1:1"])
def test_libsvm_malformed_fails(lines, line):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        P.parse_libsvm(lines(line)).collect()


@pytest.mark.parametrize("width,kind", [(4, DenseVector), (40, SparseVector)])
def test_to_vector(lines, width, kind):
    parsed = P.parse_libsvm(lines("0 1:1.0 3:2.5", "1"))
    rows = P.to_vector(parsed, width).orderBy("label").collect()
    assert all(isinstance(r.features, kind) and r.features.size == width for r in rows)
    assert rows[0].features.toArray().tolist()[:3] == [1.0, 0.0, 2.5]
    assert not rows[1].features.toArray().any()


@pytest.mark.parametrize("width", [2, 20])
def test_to_vector_beyond_width_fails(lines, width):
    with pytest.raises(Exception):
        P.to_vector(P.parse_libsvm(lines(f"0 {width + 1}:1.0")), width).collect()


def test_parse_int(lines):
    good = P.parse_int(lines("3", "-4", "+5"))
    assert [r.number for r in good.collect()] == [3, -4, 5]
    for bad in ("x", " 7", "1.0", "", "99999999999"):
        with pytest.raises(Exception):
            P.parse_int(lines(bad)).collect()
    lenient = P.parse_int(lines("3", "x", " 7", "99999999999"), strict=False)
    assert [r.number for r in lenient.collect()] == [3]


def test_tokenize_edges(lines):
    def words(line):
        return [r.word for r in P.tokenize(lines(line)).collect()]
    assert words("a b ") == ["a", "b"]
    assert words("a  b") == ["a", "", "b"]
    assert words(" a") == ["", "a"]
    assert words("") == [""]
    assert words("   ") == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=2, max_size=6))
def test_label_csv_round_trip(spark, numbers):
    df = spark.createDataFrame([(",".join(map(repr, numbers)),)], "value STRING")
    row = P.parse_label_csv(df).first()
    assert row.label == numbers[0]
    assert all(math.isclose(a, b) for a, b in zip(row.features, numbers[1:]))


def test_clean_filter_stays_on_the_raw_line(lines):
    plan = P.clean_lines(lines("a"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan.split("Filter", 1)[-1] or "Filter" not in plan


@pytest.mark.parametrize("width", [5, 40])
@pytest.mark.parametrize("items", ["9:1 2:1", "0:5 2:1", "2:1 2:7", "3:1 2:1", "1:1 41:1"])
def test_indices_must_increase_within_the_width(lines, width, items):
    if width == 40 and items == "9:1 2:1":
        items = "39:1 2:1"
    with pytest.raises(Exception, match="must increase strictly"):
        P.to_vector(P.parse_libsvm(lines(f"1 {items}")), width).collect()
