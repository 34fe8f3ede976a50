"""The command line drives the same functions end to end."""

import json

from strata.cli import main, register_layers
from strata.sinks.files import write_json
from strata.sources.songs import load_songs
from tests.conftest import SF_SMALL


def test_cli_medallion_gold_extract_probe(spark, tmp_dir, capsys):
    songs = load_songs(spark, SF_SMALL)
    write_json(songs, f"{tmp_dir}/landing")
    songs.write.parquet(f"{tmp_dir}/songs_parquet")

    assert main(["medallion", "--source", f"{tmp_dir}/landing", "--target", f"{tmp_dir}/lake"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["expectations"]["rows"] > 0

    assert main(["gold", "--silver", f"{tmp_dir}/lake/silver", "--target", f"{tmp_dir}/gold2"]) == 0
    names = register_layers(spark, f"{tmp_dir}/lake/silver", f"{tmp_dir}/gold2",
                            f"{tmp_dir}/lake/bronze")
    assert "album_releases_by_year" in names
    n = spark.sql("SELECT count(*) FROM songs_silver WHERE release_year IS NOT NULL").first()[0]
    total = spark.sql("SELECT sum(total_songs) FROM album_releases_by_year").first()[0]
    assert 0 < total <= n

    for kind in ["complete", "recent", "top-artists", "sample"]:
        assert main(["extract", "--source", f"{tmp_dir}/songs_parquet",
                     "--out", f"{tmp_dir}/x_{kind}", "--kind", kind, "--seed", "3"]) == 0
    assert spark.read.json(f"{tmp_dir}/x_sample").count() == 1000 or \
        spark.read.json(f"{tmp_dir}/x_sample").count() == songs.where("song_id IS NOT NULL").count()

    assert main(["probe", "--source", f"{tmp_dir}/songs_parquet"]) == 0
    probe = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert probe["total_rows"] == songs.count()


def test_register_layers_skips_missing_gold(spark, tmp_dir):
    from strata.plans.silver import silver
    silver(load_songs(spark, SF_SMALL), as_of_year=2025).write.parquet(f"{tmp_dir}/silver")
    names = register_layers(spark, f"{tmp_dir}/silver", f"{tmp_dir}/no_gold_yet")
    assert names == ["songs_silver"]
    assert spark.sql("SELECT count(*) FROM songs_silver").first()[0] > 0
