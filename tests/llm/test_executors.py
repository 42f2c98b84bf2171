"""What the text operators leave on an executor: files of derived tables, workers, memory."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tideline.llm import components as components_module, flat, jaccard, langid, quality, substring
from tideline.llm.components import components
from tideline.llm.packed import unpack
from tideline.session import materialise


def test_often_counts_as_unique_does():
    rng = np.random.default_rng(5)
    for least in (1, 4, 9):
        parts = [rng.integers(0, 40, n, dtype=np.uint64) for n in (0, 3, 200)]
        value, count = np.unique(np.concatenate(parts), return_counts=True)
        got = jaccard._often(parts, least)
        assert [x.tolist() for x in got] == [value[count >= least].tolist(), count[count >= least].tolist()]
    assert jaccard._often([np.zeros(0, np.uint64)], 4)[0].size == 0


@pytest.fixture
def many_partitions(spark):
    """Shuffles of 40 partitions that stay apart, as far as anyone leaves them so."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_small_derived_tables_are_few_files(spark, documents, prose, many_partitions, monkeypatch):
    """However many partitions the shuffles have: a file costs an executor several processes."""
    files = []

    def counted(*args):
        table = materialise(*args)
        files.append((args[1], len(table.inputFiles())))
        return table

    for module in (jaccard, components_module):
        monkeypatch.setattr(module, "materialise", counted)
    links = spark.createDataFrame([(i, i + 1) for i in range(100)], "a long, b long")
    assert components(links).where("component = 0").count() == 101
    assert max(n for _, n in files) <= 1, files
    files.clear()
    jaccard.similar(documents(prose)).collect()
    most = max(spark.sparkContext.defaultParallelism, 3)  # 3: partitions of the documents
    assert max(n for _, n in files) <= most, files


def python_steps(plan):
    """Steps in Python of each stage of a plan, by its final text."""
    text = plan._jdf.queryExecution().executedPlan().toString()
    text = text.split("== Initial Plan ==")[0]
    depth_of = lambda line: len(line) - len(line.lstrip(" :+-*"))
    stages, path = {}, []
    for line in text.split("\n"):
        depth = depth_of(line)
        path = [(d, s) for d, s in path if d < depth]
        above = path[-1][1] if path else 0
        stage = len(stages) + 1 if "Exchange" in line or not path else above
        stages.setdefault(stage, 0)
        stages[stage] += "MapInArrow" in line
        path.append((depth, stage))
    return stages


def test_a_task_has_one_step_in_python(spark, documents, prose, monkeypatch):
    """Each takes a worker of its own, whose memory stays with the executor."""
    rows = spark.range(50).selectExpr("id AS key", "concat('t', id) AS text")
    packed = jaccard._among(rows, rows.where("key < 3").select("key"), pack=True)
    assert max(python_steps(packed).values()) == 1
    assert {r["key"]: unpack([r["packed"]])[0] for r in packed.collect()}.items() >= {(k, f"t{k}".encode()) for k in range(3)}
    found = substring.remove_repeats(documents(prose))
    found.collect()
    assert max(python_steps(found).values()) == 1


@pytest.mark.parametrize("operator", ["language", "quality"])
def test_texts_are_handed_on_in_parts(operator):
    """A step that adds columns to texts holds a part of a batch of them, not all with what it made of them."""
    class Rows:
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

        def mapInArrow(self, run, schema):
            return run

    texts = [None, "", *[f"some words of text {i} " * 200 for i in range(500)], None]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    if operator == "language":
        run = langid.identify(Rows(), langid.ContextTrees({"en": ["some words of text"], "xx": ["zzz qqq"]}))
    else:
        run = quality.classify(Rows(), quality.AdditiveModel(np.zeros((0, len(quality.FEATURES))), np.zeros(0, np.int64)))
    parts = list(run(iter([batch])))
    assert max(p.num_rows for p in parts) * 4000 < 2 * flat.PART_BYTES
    assert pa.Table.from_batches(parts).select(["doc_id", "text"]).to_pydict() == batch.to_pydict()
