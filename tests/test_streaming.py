from conftest import write_text
from tablewright.streaming import incremental_filter_csv_copy


def test_incremental_runs_process_only_new_files(spark, workdir):
    land, out, ckpt = f"{workdir}/land", f"{workdir}/out", f"{workdir}/ckpt"
    write_text(f"{land}/a.csv", "Code,n\nCAE,1\nXYZ,2\n")
    first = incremental_filter_csv_copy(spark, land, out, ckpt, timeout_s=120)
    assert sorted(r["n"] for r in first.collect()) == ["1"]
    write_text(f"{land}/b.csv", "Code,n\nCAE,3\nCAE,4\ncae,5\n")
    second = incremental_filter_csv_copy(spark, land, out, ckpt, timeout_s=120)
    assert sorted(r["n"] for r in second.collect()) == ["1", "3", "4"]
    # a run with nothing new changes nothing
    third = incremental_filter_csv_copy(spark, land, out, ckpt, timeout_s=120)
    assert third.count() == 3


def test_backlog_split_into_micro_batches(spark, workdir):
    land, out, ckpt = f"{workdir}/land2", f"{workdir}/out2", f"{workdir}/ckpt2"
    for i in range(5):
        write_text(f"{land}/f{i}.csv", f"Code,n\nCAE,{i}\nXYZ,x\n")
    got = incremental_filter_csv_copy(spark, land, out, ckpt, max_files_per_trigger=2, timeout_s=120)
    assert sorted(r["n"] for r in got.collect()) == ["0", "1", "2", "3", "4"]


def test_empty_landing_folder(spark, workdir):
    import os

    import pytest

    from conftest import local_path
    from tablewright.errors import TableJobError
    land = f"{workdir}/land3"
    os.makedirs(local_path(land))
    with pytest.raises(TableJobError, match="pass names"):
        incremental_filter_csv_copy(spark, land, f"{workdir}/out3", f"{workdir}/ckpt3", timeout_s=60)
    got = incremental_filter_csv_copy(spark, land, f"{workdir}/out3", f"{workdir}/ckpt3",
                                      names=["Code", "n"], timeout_s=60)
    assert got.count() == 0
    write_text(f"{land}/a.csv", "Code,n\nCAE,1\n")
    got = incremental_filter_csv_copy(spark, land, f"{workdir}/out3", f"{workdir}/ckpt3",
                                      names=["Code", "n"], timeout_s=60)
    assert [r["n"] for r in got.collect()] == ["1"]
