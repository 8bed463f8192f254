import datetime as dt
import json

from turnstone.sources import register


def test_current_row_wins(spark, tmp_path):
    (tmp_path / "now.json").write_text(json.dumps([{"source_member_id": "1", "display_name": "Ann", "is_current": True, "date_of_birth": "31/1/1970"}]))
    (tmp_path / "then.json").write_text(json.dumps([{"source_member_id": "1", "display_name": "Old Ann", "is_current": False, "archived_date": "2020-05-01"}, {"source_member_id": "2", "display_name": "Bo", "is_current": False, "date_of_birth": "never"}]))
    members = register.from_json_snapshots(spark, [str(tmp_path / "now.json"), str(tmp_path / "then.json")], "sa")
    got = {r.source_member_id: r for r in members.collect()}
    assert got["1"].display_name == "Ann" and got["1"].date_of_birth == dt.date(1970, 1, 31) and got["2"].date_of_birth is None
    assert got["1"].member_id != got["2"].member_id
    register.write_register(members, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).where("jurisdiction = 'sa'").count() == 2


def test_service_snapshots(spark, tmp_path):
    import datetime as dt
    import json

    from turnstone.sources import register

    person = {"pm_Id": 7, "pm_FirstName": " Ida ", "pm_LastName": "Moss", "pm_DateOfBirth": "Jul 12 1975 12:00AM", "mb_ElectedDate": "2010-03-20T00:00:00", "pp_name": "Greens", "ho_name": "Upper", "pm_Deceased": False, "pm_Title": ""}
    (tmp_path / "current.json").write_text(json.dumps([person]))
    (tmp_path / "former.json").write_text(json.dumps([person | {"pp_name": "Old", "pm_ArchiveDate": "2009-01-01"}, {"pm_Id": 8, "pm_LastName": "Reed", "pm_DateOfBirth": "some day"}, {"pm_LastName": "Nobody"}]))
    rows = {r.source_member_id: r for r in register.from_service_snapshots(spark, [str(tmp_path / "current.json")], [str(tmp_path / "former.json")]).collect()}
    assert set(rows) == {"7", "8"} and rows["7"].is_current and not rows["8"].is_current
    assert (rows["7"].display_name, rows["7"].party_name, rows["7"].house, rows["7"].title) == ("Ida Moss", "Greens", "Upper", None)
    assert rows["7"].date_of_birth == dt.date(1975, 7, 12) and rows["7"].elected_date == dt.date(2010, 3, 20) and rows["8"].date_of_birth is None and rows["8"].display_name == "Reed"


def test_member_pages(spark, tmp_path):
    import datetime as dt

    from turnstone.sources import register

    (tmp_path / "now.html").write_text("<table><tr><th>Name</th><th>House</th><th>Party</th><th>Position</th></tr><tr><td><a class='x' href='/m?pk=11'>Birch, Lou</a></td><td>LA</td><td>Reds</td><td>Minister<br>Member for Oaks</td></tr></table>")
    (tmp_path / "then.html").write_text("<table id='formerMembersTable'><tr><td><a href='/former-member-details?pk=12'>Cane, Mr Hugh Ian</a></td><td>5/03/1920</td><td>Deceased</td></tr><tr><td><a href='/former-member-details?pk=11'>Birch, Ms Lou</a></td><td></td><td></td></tr><tr><td>Nobody</td></tr></table>")
    rows = {r.source_member_id: r for r in register.from_pages(spark, [str(tmp_path / "now.html")], [str(tmp_path / "then.html")]).collect()}
    assert set(rows) == {"11", "12"}
    assert (rows["11"].display_name, rows["11"].house, rows["11"].electorate, rows["11"].party_name, rows["11"].is_current) == ("Lou Birch", "Legislative Assembly", "Oaks", "Reds", True)
    assert (rows["12"].display_name, rows["12"].title, rows["12"].date_of_birth, rows["12"].deceased, rows["12"].is_current) == ("Hugh Ian Cane", "Mr", dt.date(1920, 3, 5), True, False)


def test_published_stages(spark):
    from turnstone.sources import vocabulary

    rows = vocabulary.stage_table(spark).collect()
    assert {r.jurisdiction for r in rows} == {"wa", "sa", "nsw", "au"} and all(vocabulary.STAGES[r.stage_order] == r.stage for r in rows)
    assert ("nsw", "agreement in principle", "second_reading") in {(r.jurisdiction, r.name_lower, r.stage) for r in rows}
