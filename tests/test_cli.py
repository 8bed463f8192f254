import json

from turnstone import cli


def test_commands_without_a_session(capsys, tmp_path):
    assert cli.main(["sources"]) == 0 and set(json.loads(capsys.readouterr().out)) >= {"wa", "sa", "nsw", "au", "nz", "scot"}
    assert cli.main(["schema"]) == 0 and "talkers" in json.loads(capsys.readouterr().out)
    assert cli.main(["harvest", "nz", str(tmp_path), "--start", "2025-01-01", "--end", "2025-01-02"]) == 2


def test_normalize_then_aggregate(spark, capsys, tmp_path):
    from test_gold import DAY

    folder = tmp_path / "raw" / "wa" / "2025-03-04" / "uh"
    folder.mkdir(parents=True)
    (folder / "1.xml").write_text(DAY)
    (folder / "meta.json").write_text('{"documents": 1}')
    raw, silver, out = (str(tmp_path / n) for n in ("raw", "silver", "gold"))
    assert cli.main(["normalize", raw, silver]) == 0
    assert cli.main(["aggregate", silver, out, "--raw", raw, "--only", "member_activity", "sitting_days"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"member_activity": 4, "sitting_days": 1}
    assert cli.main(["embed", silver, "--provider", "hashing"]) == 0 and json.loads(capsys.readouterr().out.splitlines()[-1]) == {"days": 1}
    assert cli.main(["prune", silver]) == 0
