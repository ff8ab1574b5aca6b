import json

from reelhouse.__main__ import main


def test_cli_ingest_and_run(spark, tmp_path, capsys):
    src = tmp_path / "extract"
    (src / "pages").mkdir(parents=True)
    items = [{"id": i, "title": f"t{i}", "original_language": "en", "genre_ids": [1], "popularity": float(i),
              "release_date": "2000-01-01", "vote_average": 5.0, "vote_count": 1} for i in range(1, 21)]
    (src / "pages" / "p1.json").write_text(json.dumps({"page": 1, "total_pages": 1, "results": items}))
    (src / "genres.json").write_text(json.dumps({"genres": [{"id": 1, "name": "Action"}]}))
    (src / "countries.json").write_text(json.dumps([{"iso_3166_1": "FR", "english_name": "France", "native_name": "France"}]))
    (src / "languages.json").write_text(json.dumps([{"iso_639_1": "en", "english_name": "English", "name": "English"}]))
    root = str(tmp_path / "lake")
    main(["ingest", "--src", str(src), "--root", root, "--date", "2024-03-01"])
    assert "'movies': 20" in capsys.readouterr().out
    main(["all", "--root", root, "--date", "2024-03-01", "--namespace", "rawc", "--marts", "martsc"])
    assert spark.table("martsc.fact_items").count() == 20
    main(["test", "--root", root, "--namespace", "rawc", "--marts", "martsc"])  # raises on a failed test
