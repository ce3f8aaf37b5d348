"""Malformed CSV rows go to a reject table, in file order."""

from blotter.sources.incidents import read_incidents_csv_rejects

HEAD = "year,month,day,hour,city,location_area,offense_category_name,population,total_officers,male_officer,female_officer,officers_per_1000_people,crime_rate_per_1000_people"


def test_rejects_keep_their_text_and_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEAD, "2020,1,2,3,A,Street,Other,1,2,1,1,0.5,1.5", "2020,x,2,3,A,Street,Other,1,2,1,1,0.5,1.5"]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([HEAD, "2021,1,2,,B,,Other,,,,,,", "2021,1,2", "2021,2,30,1,B,Home,Other,1,1,1,1,1,1"]) + "\n")
    good, bad = read_incidents_csv_rejects(spark, str(tmp_path))
    assert [(r.year, r.city, r.hour) for r in good.orderBy("row_order").collect()] == [(2020, "A", 3), (2021, "B", None)]
    rows = bad.orderBy("row_order").collect()
    assert [r.reason for r in rows] == ["malformed", "malformed", "no such date"]
    assert rows[0].text.startswith("2020,x") and rows[1].text == "2021,1,2" and rows[2].text.startswith("2021,2,30")


def test_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + "\n")
    good, bad = read_incidents_csv_rejects(spark, str(tmp_path))
    assert good.count() == bad.count() == 0
