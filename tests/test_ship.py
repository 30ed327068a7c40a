import subprocess
import sys
from pathlib import Path

CODE = """
import sys; sys.path.insert(0, {repo!r})
from tidemill.session import local_session, ship
from tidemill.functions import vectors
from pyspark.sql import functions as F
s = ship(local_session(cores=1))
df = s.createDataFrame([("alpha",)], "t string")
assert len(df.select(vectors.embed(F.col("t"), vectors.hashed_words(8))).first()[0]) == 8
print("done")
"""


def test_executors_find_the_package_from_anywhere(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent)
    out = subprocess.run([sys.executable, "-c", CODE.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]


def test_what_was_written_between_is_released(spark):
    from tidemill.session import _made, fresh_dir, release, written

    _made.clear()
    df = written(spark.range(3), "t")
    assert df.count() == 3 and len(_made) == 1
    fresh_dir(spark, "never written")
    assert release(spark) == 1 and not _made and release(spark) == 0
