"""A run compares its listing with the ledger once, whatever it then detects."""

from castframe.sinks.batches import DetectionLedger
from workload.queries import QUERIES


def test_each_run_compares_its_listing_once(spark, sf_dir, monkeypatch):
    calls = []
    compared = DetectionLedger.compared
    monkeypatch.setattr(DetectionLedger, "compared", lambda self, listed: calls.append(1) or compared(self, listed))
    rows = QUERIES["frames_by_run"](spark, sf_dir).collect()
    assert len(calls) == 2 and {r.batch for r in rows} == {0, 1}
    ids = [r.face_id for r in QUERIES["lasting_face_ids"](spark, sf_dir).collect()]
    assert sorted(ids) == list(range(sum(r.faces for r in rows)))
