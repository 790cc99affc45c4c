import json

from ledgerloom.sources import cards
from ledgerloom.streaming import incremental
from tests.test_cards import v2


def test_files_arrive_once(spark, tmp_path):
    source, target, marks = tmp_path / "in", tmp_path / "out", tmp_path / "marks"
    source.mkdir()
    for round_, names in enumerate((["a.json"], ["b.json", "c.txt"])):
        for n in names:
            (source / n).write_text(json.dumps(v2(name=n)))
        records = cards.scan(incremental.new_files(spark, str(source)))
        incremental.append_available(records, str(target), str(marks)).awaitTermination()
        assert spark.read.parquet(str(target)).count() == round_ + 1
    assert {r.status for r in spark.read.parquet(str(target)).collect()} == {"valid"}
