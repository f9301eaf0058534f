import os

from packshot import runtime


def test_stored_tables_lie_in_one_folder_and_go_with_it(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "shared")
    monkeypatch.setattr(runtime, "scratch_folder", lambda spark: folder + "/")
    stored = runtime.materialise(spark.range(5))
    assert stored.count() == 5
    own = runtime.application_folder(spark)
    assert own.startswith(folder) and len(os.listdir(own)) == 1
    assert runtime.remove_stored(spark) and not os.path.exists(own) and os.path.isdir(folder)
    assert not runtime.remove_stored(spark)
