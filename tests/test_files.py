"""The shared folder, names that one writer gets, and an entry that survives what is missing."""

import subprocess
import sys
import types
from pathlib import Path

import pytest

from candlewright.sources import files

ROOT = Path(__file__).resolve().parents[1]


def stub(master, **conf):
    values = dict(conf)
    setting = types.SimpleNamespace(get=lambda k, d=None: values.get(k, d), set=values.__setitem__)
    return types.SimpleNamespace(conf=setting, sparkContext=types.SimpleNamespace(master=master)), values


def test_a_configured_folder_is_used():
    spark, _ = stub("spark://x:7077", **{"spark.checkpoint.dir": "hdfs://x/shared/"})
    assert files.shared_folder(spark) == "hdfs://x/shared"


def test_only_a_local_master_gets_a_local_folder():
    spark, values = stub("local[4]")
    made = files.shared_folder(spark)
    assert made.startswith("file:///") and values["spark.checkpoint.dir"] == made == files.shared_folder(spark)
    for master in ("spark://x:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
            files.shared_folder(stub(master, **{"spark.sql.warehouse.dir": "file:/tmp/w"})[0])
    assert files.shared_folder(stub("yarn", **{"spark.sql.warehouse.dir": "hdfs://x/w"})[0]) == "hdfs://x/w"


def test_one_writer_gets_a_name(spark, tmp_path):
    path = f"file://{tmp_path}/names/000000000001"
    assert files.create_once(spark, path, "first") and not files.create_once(spark, path, "second")
    assert files.read_text(spark, path) == "first" and files.numbers_in(spark, f"file://{tmp_path}/names") == [1]
    assert [n for n in files.names_in(spark, f"file://{tmp_path}/names") if "crc" not in n] == ["000000000001"]


@pytest.mark.parametrize("missing", ["xxhash", "candlewright.llm.queries", "corpus_pipeline", "public_tokenizers"])
def test_the_core_queries_survive_a_missing_module(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q = e.queries(); assert 'candles_1h' in q and 'candles_1h' in e.oracle_sql(); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
    assert int(done.stdout) >= 50


def test_intermediate_tables_can_be_cleared(spark):
    df, path = files.written(spark.range(3), "kept")
    assert df.count() == 3 and files.names_in(spark, path)
    files.clear_tables(spark)
    assert not files.names_in(spark, files.app_folder(spark))
