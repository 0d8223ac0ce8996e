import pytest
from pyspark.sql import functions as F

from tallyloom.plans import storage
from tallyloom.sources import sinks
from tallyloom.sources.adjacency import read_adjacency
from tallyloom.sources.text import read_documents, read_lines


def offsets(data):
    at, out = 0, []
    for line in data.split(b"\n"):
        out.append((at, line.removesuffix(b"\r").decode()))
        at += len(line) + 1
    return out[:-1] if data.endswith(b"\n") else out


MANY = "".join(f"line {i} " + "x" * (i % 90) + "\n" for i in range(4000))
DATA = ("first\n\nthird é line\r\n" + MANY + "last").encode()


@pytest.mark.parametrize("split", [None, 5000])
def test_document_ids_are_byte_offsets(spark, tmp_path, split):
    (tmp_path / "a.txt").write_bytes(DATA)
    (tmp_path / "b.txt").write_bytes(DATA[7:])
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        rows = read_documents(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, data in (("a.txt", DATA), ("b.txt", DATA[7:])):
        found = sorted((r.offset, r.text) for r in rows if r.path.endswith(name))
        assert found == offsets(data)
    second = min(r.doc_id for r in rows if r.path.endswith("b.txt"))
    assert all(r.doc_id == r.offset + (second if r.path.endswith("b.txt") else 0) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)


def test_read_lines(spark, tmp_path):
    (tmp_path / "x.txt").write_text("a b\n\nccc d\n")
    assert sorted(r.line for r in read_lines(spark, str(tmp_path)).collect()) == ["", "a b", "ccc d"]


def test_read_adjacency(spark, tmp_path):
    (tmp_path / "g.txt").write_text("1 2 3\n4\n")
    nodes, edges = read_adjacency(spark, str(tmp_path))
    assert nodes.count() == 2 and edges.count() == 2


def test_tsv_output_is_plain_and_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_tsv(spark.createDataFrame([("old", 1)], "k string, n bigint"), path)
    rows = spark.createDataFrame([('say "x"', 2), ("a,b", 1), ("", 3)], "k string, n bigint")
    sinks.write_ordered_tsv(rows, path, "n")
    lines = [r.value for r in spark.read.text(path).collect()]
    again = [tuple(r) for r in sinks.read_tsv(spark, path, "k string, n bigint").orderBy("n").collect()]
    assert again == [("a,b", 1), ('say "x"', 2), (None, 3)]
    assert sorted(lines) == ["\t3", 'a,b\t1', 'say "x"\t2']
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part") and "old" in p.read_text()]


def test_ordered_output_over_several_files(spark, tmp_path):
    path = tmp_path / "sorted"
    sinks.write_ordered_tsv(spark.range(1000).select((999 - F.col("id")).alias("n")), str(path), "n")
    parts = sorted(p for p in path.iterdir() if p.name.startswith("part"))
    assert [int(x) for p in parts for x in p.read_text().split()] == list(range(1000))


def test_rows_round_trip(spark, tmp_path):
    path = str(tmp_path / "rows")
    sinks.write_rows(spark.range(5), path)
    sinks.write_rows(spark.range(3), path)
    assert sinks.read_rows(spark, path).count() == 3


def test_a_failed_replacement_leaves_the_rows_before(spark, tmp_path):
    path = str(tmp_path / "versions")
    assert sinks.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        sinks.read_current(spark, path)
    broken = spark.range(9, numPartitions=3).select(
        F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("bigint")).alias("id"))
    for version, size in enumerate((5, 3, 0), 1):
        with pytest.raises(Exception, match="broken"):
            sinks.replace_rows(broken, path)
        sinks.replace_rows(spark.range(size), path, ["a", "b"])
        current = sinks.current_version(spark, path)
        assert (current.version, current.inputs) == (version, ["a", "b"])
        held = sinks.read_current(spark, path)
        assert held.count() == size
    # A reader that has begun goes on with its version.
    sinks.replace_rows(spark.range(4), path)
    assert held.count() == 0 and sinks.read_current(spark, path).count() == 4


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_batch_is_looked_up_in_the_buckets(spark, tmp_path):
    index = spark.range(4000).selectExpr(
        "concat('t', id % 50) as term", "id div 50 as block", "array(id) as postings").unionByName(
        spark.range(900).selectExpr("'hot' as term", "id as block", "array(id) as postings"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for times in (1, 2):
            sinks.save_keyed_table(index, "keyed_test", str(tmp_path / f"keyed{times}"), buckets=4 * times)
        wanted = spark.createDataFrame([("t3",), ("hot",), ("t3",), ("absent",), (None,)], "term string")
        found = sinks.lookup_batch(spark, "keyed_test", wanted)
        assert found.count() == 80 + 900 and {r.term for r in found.collect()} == {"t3", "hot"}
        # Only the keys are shuffled; the table is read in its buckets.
        plan = plan_of(found).split("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        sizes = [r["count"] for r in spark.table("keyed_test_rows").where("term = 'hot'").groupBy(
            F.input_file_name()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 300
        assert sinks.lookup_batch(spark, "keyed_test", wanted.limit(0)).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("rows", "blocks"):
            spark.sql(f"DROP TABLE IF EXISTS keyed_test_{name}")


class Context:
    master = "spark://somewhere"

    def getCheckpointDir(self):
        return None


class Session:
    sparkContext = Context()

    def __init__(self, named):
        self.conf = {"spark.checkpoint.dir": named}


def test_the_work_folder_is_the_named_one():
    assert storage.work_folder(Session("hdfs://shared/folder")) == "hdfs://shared/folder"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.work_folder(Session(None))


def test_materialized_rows_are_read_from_the_work_folder(spark):
    table = storage.materialize(spark.range(3), "numbers")
    folder = storage.work_folder(spark).removeprefix("file:")
    assert table.count() == 3 and all(folder in f for f in table.inputFiles())
