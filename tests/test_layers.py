from __future__ import annotations

import os
import shutil

import pytest

from promoledger.queries import views

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")
def test_a_layer_follows_its_tables(spark, tmp_path):
    shutil.copy(f"{FOLDER}/part.parquet", tmp_path / "part.parquet")
    built = []

    def build(session, folder):
        built.append(folder)
        return views.table(session, folder, "part").select("p_partkey")

    first = views.layer(spark, str(tmp_path), "parts", build)
    rows = first.count()
    assert views.layer(spark, str(tmp_path), "parts", build).count() == rows and len(built) == 1
    views.table(spark, str(tmp_path), "part").limit(3).write.parquet(str(tmp_path / "few"))
    few = next(p for p in (tmp_path / "few").iterdir() if p.name.startswith("part-"))
    shutil.copy(few, tmp_path / "part.parquet")
    (tmp_path / ".part.parquet.crc").unlink(missing_ok=True)
    assert views.layer(spark, str(tmp_path), "parts", build).count() == 3 and len(built) == 2
