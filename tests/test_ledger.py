"""Only new or changed files are read again."""

import os

from marketloom.sources import ledger


def test_a_rerun_reads_new_and_changed_files_only(spark, tmp_path):
    folder, book = str(tmp_path / "raw"), str(tmp_path / "ledger")
    os.makedirs(f"{folder}/sub")

    def put(name, text, age):
        path = f"{folder}/{name}"
        with open(path, "w") as file:
            file.write(text)
        os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))

    def run(n):
        found = ledger.unread(ledger.listed(spark, [folder]), ledger.read_ledger(spark, book))
        found.write.parquet(str(tmp_path / f"new{n}"))
        new = spark.read.parquet(str(tmp_path / f"new{n}"))
        values = sorted(r.value for r in ledger.lines_of(spark, [folder], new).collect())
        ledger.record(new, book)
        return values

    put("a.json", "a\nb", 500)
    put("sub/c.json", "c", 400)
    put("other.txt", "no", 400)
    assert run(1) == ["a", "b", "c"]
    assert run(2) == []
    put("sub/c.json", "c2", 300)
    put("late.json", "d", 450)
    assert run(3) == ["c2", "d"]
    assert run(4) == []
