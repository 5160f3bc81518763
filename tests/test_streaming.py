"""File-stream ingest: same rows as the batch ingest, files processed once, late files picked up."""

import shutil
import uuid

from tests.test_pipeline import landed  # noqa: F401  (module fixture: zstd daily files)
from vesseltrack.streaming import ingest_stream


def test_stream_ingest(spark, landed, tmp_path):  # noqa: F811
    root, n = landed
    src = tmp_path / "landing"
    src.mkdir()
    files = sorted(p for p in __import__("os").listdir(root) if p.endswith(".csv.zst"))
    for f in files[:-3]:
        shutil.copy(f"{root}/{f}", src / f)
    db = f"s{uuid.uuid4().hex[:8]}_bronze"
    table, log = f"{db}.ais_raw", f"{db}.ais_files"
    ckpt = str(tmp_path / "ckpt")
    q = ingest_stream(spark, str(src), table, log, checkpoint=ckpt, max_files_per_trigger=4)
    q.awaitTermination(300)
    first = spark.table(table).count()
    # a rerun over the same folder adds nothing
    q = ingest_stream(spark, str(src), table, log, checkpoint=ckpt, max_files_per_trigger=4)
    q.awaitTermination(300)
    assert spark.table(table).count() == first
    # late files are picked up by the next run
    for f in files[-3:]:
        shutil.copy(f"{root}/{f}", src / f)
    q = ingest_stream(spark, str(src), table, log, checkpoint=ckpt, max_files_per_trigger=4)
    q.awaitTermination(300)
    assert spark.table(table).count() == n
    assert spark.table(table).select("_source_file").distinct().count() == len(files)
    assert spark.table(log).select("file").distinct().count() == len(files)


def test_reordered_header_is_refused_by_batch_and_stream(spark, tmp_path):
    import pytest

    from vesseltrack.schemas import AIS_COLUMNS
    from vesseltrack.sources.ais import read_ais
    names = list(AIS_COLUMNS)
    i, j = names.index("latitude"), names.index("longitude")
    names[i], names[j] = names[j], names[i]
    src = tmp_path / "landing"
    src.mkdir()
    (src / "ais-2024-01-01.csv").write_text(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_ais(spark, str(src)).collect()
    db = f"s{uuid.uuid4().hex[:8]}"
    q = ingest_stream(spark, str(src), f"{db}.ais_raw", f"{db}.ais_files", checkpoint=str(tmp_path / "ckpt"), pattern="*.csv")
    with pytest.raises(Exception, match="(?i)header"):
        q.awaitTermination(120)
    assert not spark.catalog.tableExists(f"{db}.ais_raw") or spark.table(f"{db}.ais_raw").count() == 0
