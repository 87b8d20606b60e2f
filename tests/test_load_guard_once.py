"""The load guard reads history and new rows once, and ids are measured without the text beside them."""

from __future__ import annotations

from registry.frames import Frames
from rillflow.operators import joins
from tests.conftest import SF_DIR
from tests.test_runs_once import counted


def test_load_guard_reads_history_and_new_rows_once(spark):
    history, read_old = counted(spark.range(100).withColumnRenamed("id", "k"))
    new, read_new = counted(spark.range(90, 130).withColumnRenamed("id", "k"))
    done = joins.already_in(history, new, "k")
    for _ in range(2):
        assert sorted(r.k for r in done.collect()) == list(range(90, 100))
    assert (read_old.value, read_new.value) == (100, 40)


def test_tables_whose_ids_fit_are_broadcast_without_their_text(spark, monkeypatch):
    frames = Frames(spark, SF_DIR)
    n = frames.users.count()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 16 * n)
    assert frames.id_fits["users_fit"] and not frames.fits["users_fit"]
    assert frames.dim_user.inputFiles()  # written once, as a run does
