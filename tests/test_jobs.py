import json

import pytest

from conftest import rows_of
from titleprep import scale
from titleprep.operators.model import TitleClassifier
from titleprep.plans import jobs

N = r"\N"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    header = ",tconst,primaryTitle,originalTitle,startYear,endYear,runtimeMinutes,numVotes"
    n = 0

    def lines(count, label):
        nonlocal n
        out = [header + (",label" if label else "")]
        for i in range(count):
            n += 1
            title = f'"Film, the {n}th ""one"""' if n % 4 == 0 else f"Film {n}"
            votes = "" if n % 5 == 0 else f"{n * 10}.0"
            row = f"{i},tt{n:03d},{title},,{1990 + n % 9 if n % 7 else N},{N},{N if n % 6 == 0 else 60 + n},{votes}"
            out.append(row + (f",{n % 3 > 0}" if label else ""))
        return "\n".join(out) + "\n"

    (root / "train-1.csv").write_text(lines(30, True))
    (root / "train-2.csv").write_text(lines(30, True))
    (root / "val.csv").write_text(lines(10, False))
    (root / "test.csv").write_text(lines(10, False))
    keys = [f"tt{i:03d}" for i in range(1, n + 1)]
    writing = [{"movie": k, "writer": f"nm{(i + j) % 13}"} for i, k in enumerate(keys) for j in range(i % 3)]
    (root / "writing.json").write_text(json.dumps(writing))
    directing = {
        "movie": {str(i): k for i, k in enumerate(keys)},
        "director": {str(i): (N if i % 8 == 0 else f"nm{i % 11}") for i, _ in enumerate(keys)},
    }
    (root / "directing.json").write_text(json.dumps(directing))
    ratings = ["title,releaseDateTheaters,releaseDateStreaming,tomatoMeter,audienceScore,genre"]
    for i in range(1, 60):
        ratings.append(f"Film {i}{'x' if i % 5 == 0 else ''},{1990 + i % 9}-06-01,,{i if i % 4 else ''},{i + 20},\"Drama, War\"")
    (root / "ratings.csv").write_text("\n".join(ratings) + "\n")
    return root


def tables(spark):
    """The tables in the shared folder of this session."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(scale._own_folder(spark))
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in system.listStatus(folder)} if system.exists(folder) else set()


def paths(folder, stage):
    return {name: f"{folder}/{stage}_{name}" for name in jobs.SPLITS}


def test_all_stages_from_files_to_files(spark, folder):
    base = {
        "train": f"{folder}/train-*.csv",
        "validation": f"{folder}/val.csv",
        "test": f"{folder}/test.csv",
    }
    merged, clean, features, rich = (paths(folder, s) for s in ("merged", "clean", "features", "rich"))
    before = tables(spark)
    jobs.merge_files(spark, base, f"{folder}/writing.json", f"{folder}/directing.json", merged)
    assert tables(spark) == before

    reports = jobs.profile_file(spark, merged["train"])
    checks = {(r["section"], r["item"]): r["value"] for r in reports["checks"].collect()}
    assert checks["rows", "total_rows"] == 60 and checks["sentinels", "directors"] > 0
    assert reports["duplicates"].first()[0] == 0
    assert reports["columns"].count() == 11

    written = jobs.clean_files(spark, merged, clean)
    assert written["train"].inputFiles()[0].endswith(".parquet")
    frames = jobs.feature_files(spark, clean, features, single_file=True)
    assert tables(spark) == before
    assert {n: df.count() for n, df in frames.items()} == {"train": 60, "validation": 10, "test": 10}
    assert "label" in frames["train"].columns and "label" not in frames["test"].columns
    assert frames["train"].where('primaryTitle = \'Film, the 4th "one"\'').count() == 1

    out = {n: f"{folder}/pred_{n}" for n in ("validation", "test")}
    model, scores = jobs.score_files(
        spark, features, out, TitleClassifier(depths=(2,), rounds=(2,), folds=2), single_file=True
    )
    assert len(tables(spark) - before) == 1  # a report
    for path in out.values():
        text = spark.read.text(path)
        assert text.count() == 10 and {r[0] for r in text.collect()} <= {"True", "False"}
    assert 0 <= scores["accuracy"].first()[0] <= 1 and scores["importances"].count() == 8

    reports = jobs.enrich_files(spark, features, f"{folder}/ratings.csv", rich)
    assert len(tables(spark) - before) == 3
    counts = {(r["split"], r["match_stage"]): r["rows"] for r in reports["matches"].collect()}
    assert counts["train", "exact"] > 0 and counts["train", "near"] > 0
    assert sum(v for (s, _), v in counts.items() if s == "train") == 60
    assert reports["nulls"].count() == 9
    done = jobs._read(spark, rich, "csv")
    assert done["test"].count() == 10
    assert {"genre_drama", "genre_war", "has_rt_match"} <= set(done["test"].columns)
    assert "genre" not in done["test"].columns and "match_stage" not in done["test"].columns

    whole = paths(folder, "whole")
    at_once = jobs.chain_files(
        spark, base, f"{folder}/writing.json", f"{folder}/directing.json", f"{folder}/ratings.csv", whole
    )
    assert len(tables(spark) - before) == 3
    for name in jobs.SPLITS:
        assert sorted(at_once[name].columns) == sorted(done[name].columns)
        columns = sorted(done[name].columns)
        assert rows_of(at_once[name].select(columns)) == rows_of(done[name].select(columns))
