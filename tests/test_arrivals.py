"""Documents as they arrive."""

import glob
import os

from pyspark.sql import functions as F

from rowsmith.operators import documents as D
from rowsmith.streaming.arrivals import run_arrivals


def _put(root, names):
    os.makedirs(root, exist_ok=True)
    for n in names:
        with open(os.path.join(root, n), "wb") as fh:
            fh.write(n.encode() * 3)


def test_two_landings_and_a_replay(spark, tmp_dir):
    register = spark.createDataFrame([(i, f"c{i}") for i in (1, 2, 3, 4, 5)] + [(None, "none"), (3, "again")], "id INT, cred STRING")
    reads = spark.sparkContext.accumulator(0)

    def process(found):
        def count(batches):
            for b in batches:
                reads.add(b.num_rows)
                yield b

        return found.mapInArrow(count, found.schema).select("id", "cred", F.octet_length("content").alias("n"))

    def run():
        files = D.stream_documents(spark, f"{tmp_dir}/in", files_per_trigger=2)
        return run_arrivals(register, "id", files, process, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")

    _put(f"{tmp_dir}/in", ["1.pdf", "3.PDF", "9.pdf", "note.txt"])
    out = run()
    assert sorted((r.id, r.cred, r.n) for r in out.results().collect()) == [(1, "c1", 15), (3, "again", 15), (3, "c3", 15)] and reads.value == 3
    assert sorted(((r.id, r.cred) for r in out.waiting(register).collect()), key=repr) == [(2, "c2"), (4, "c4"), (5, "c5"), (None, "none")]
    # The second landing: two that were waited for, one read already (in a folder of its own).
    _put(f"{tmp_dir}/in/later", ["2.pdf", "5.pdf", "1.pdf"])
    out = run()
    assert sorted(r.id for r in out.results().collect()) == [1, 2, 3, 3, 5] and reads.value == 5
    # The last commit is lost: its batch is replayed and replaces itself.
    commits = sorted(glob.glob(f"{tmp_dir}/ckpt/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for name in (commits[-1], f"{tmp_dir}/ckpt/commits/.{os.path.basename(commits[-1])}.crc"):
        if os.path.exists(name):
            os.remove(name)
    out = run()
    assert sorted(r.id for r in out.results().collect()) == [1, 2, 3, 3, 5]
    assert [r.id for r in out.waiting(register).filter("id is not null").collect()] == [4]


def test_nothing_arrives(spark, tmp_dir):
    register = spark.createDataFrame([(1, "c")], "id INT, cred STRING")
    os.makedirs(f"{tmp_dir}/in")
    out = run_arrivals(register, "id", D.stream_documents(spark, f"{tmp_dir}/in"), lambda d: d.select("id"), f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    assert out.results().count() == 0 and out.waiting(register).count() == 1
