"""Commands over small files: what they print, what they leave in the store, and their exit codes."""

import json

import pytest

from threadloom import cli
from threadloom.functions import lookups


@pytest.fixture
def run(spark, tmp_path, capsys):
    def call(*args):
        code = cli.main(["--store", f"file://{tmp_path}/store", *args])
        return code, capsys.readouterr().out

    return call


def test_scrape_all_match_and_report(spark, tmp_path, run, monkeypatch):
    monkeypatch.setattr(lookups, "PASSES", [("new", None, 100, 50), ("top", None, 100, 50)])
    (tmp_path / "raw/json").mkdir(parents=True)
    titles = ["[UPD] Math 21 - Cruz, Juan", "[UPD] Math 21 - Reyes, Ana", "[UPD] Eng 13 - Santos, Pedro", "nothing in it", "[UPD] Fil 40 - Lim, Jose"]
    items = [{"id": f"p{i}", "title": t, "created_utc": float(i), "num_comments": 0} for i, t in enumerate(titles)]
    (tmp_path / "raw/json/a.json").write_text(json.dumps({"data": {"children": [{"kind": "t3", "data": x} for x in items]}}))
    code, out = run("scrape-all", "--raw", f"file://{tmp_path}/raw")
    assert code == 0 and "in all: 5 posts, 0 comments, 4 parsed" in out  # the second pass meets nothing new
    roster = f"file://{tmp_path}/roster"
    assert run("match", "--roster", roster) == (0, "") and run("resolve-report", "--roster", roster)[0] == 2
    people = [("1", "CRUZ, JUAN", "Juan Cruz", 0), ("2", "REYES, ANA", "Ana Reyes", 1), ("3", "REYES, ANNA", "Anna Reyes", 2), ("4", "SANTOS, MARIA", "Maria Santos", 3), ("5", "SANTOS, JOSE", "Jose Santos", 4)]
    spark.createDataFrame(people, "instructor_id string, name_normalized string, name_display string, ord long").write.parquet(f"{roster}/instructor.parquet")
    spark.createDataFrame([(i, f"C {i}") for i in range(7)], "course_id long, course_code string").write.parquet(f"{roster}/course.parquet")
    spark.createDataFrame([(i, i, "upd") for i in range(7)], "section_id long, course_id long, university_id string").write.parquet(f"{roster}/section.parquet")
    spark.createDataFrame([(i, "1") for i in range(7)], "section_id long, instructor_id string").write.parquet(f"{roster}/section_instructor.parquet")
    code, out = run("match", "--roster", roster)
    assert code == 0 and "resolved (2)" in out and "Cruz, Juan | UPD | Juan Cruz | exact | 1.0 | C 0, C 1, C 2, C 3, C 4 (+2)" in out
    assert "ambiguous (1)\n  Santos, Pedro | UPD | Maria Santos (last_name_only); Jose Santos (last_name_only)" in out and "unresolved (1)\n  Lim, Jose | UPD" in out
    code, out = run("resolve-report", "--roster", roster, "--output", str(tmp_path / "out/report.json"))
    report = json.loads((tmp_path / "out/report.json").read_text())
    assert code == 3 and (report["sample_size"], report["resolved_count"], report["acceptance_met"]) == (4, 2, False) and len(report["ambiguous"]) == 1


def test_exit_codes(spark, tmp_path, run):
    (tmp_path / "raw").mkdir()
    assert run("scrape", "--raw", f"file://{tmp_path}/raw")[0] == 2
    assert run("scrape", "--raw", f"file://{tmp_path}/raw", "--after", "soon")[0] == 1
    assert run("stats")[0] == 0 and run("clean-junk")[0] == 0
