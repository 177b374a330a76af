"""CUR-1..4 on edge documents (FIXTURES.md section 3)."""

import datetime as dt

from strata.operators import curators
from strata.schemas import FLIGHTS_RAW, HOLIDAYS_RAW, TRAFFIC_RAW, WEATHER_RAW
from strata.sources.raw import parse_documents
from tests.conftest import docs_frame


def test_traffic_types_and_partitions(spark):
    docs = docs_frame(spark, [
        '{"records":[{"center_id":"EUR_MAD_001","timestamp":"2026-04-22T10:00:00",'
        '"visitors_count":24.0,"day_of_week":"wednesday","is_holiday":"true",'
        '"weather_condition":"sunny","temperature_c":"22"}],"total_records":1}',
        '{"records":[{"center_id":"X","timestamp":"garbage","visitors_count":3000000000}]}'])
    out = curators.curate_traffic(parse_documents(docs, TRAFFIC_RAW))
    assert out.columns == ["center_id", "event_timestamp", "event_date", "visitors_count",
                           "day_of_week", "is_holiday", "weather_condition", "temperature_c",
                           "year", "month", "day"]
    rows = {r.center_id: r for r in out.collect()}
    a = rows["EUR_MAD_001"]
    assert a.event_timestamp == dt.datetime(2026, 4, 22, 10)
    assert (a.visitors_count, a.is_holiday, a.temperature_c) == (24, True, 22.0)
    assert (a.year, a.month, a.day) == (2026, 4, 22)
    x = rows["X"]
    assert x.event_timestamp is None and x.visitors_count is None and x.year is None


def test_weather_zip_carry_and_dedupe(spark):
    doc = ('{"latitude":40.4,"longitude":-3.7,"timezone":"Europe/Madrid","hourly":{'
           '"time":["2026-04-22T00:00","2026-04-22T01:00","2026-04-22T01:00"],'
           '"temperature_2m":[10.5,11,9],"precipitation":[0,0.2,0],"windspeed_10m":[3,4,5],'
           '"weathercode":[1,2]}}')
    out = curators.curate_weather(parse_documents(docs_frame(spark, [doc]), WEATHER_RAW))
    rows = sorted(out.collect(), key=lambda r: r.event_timestamp)
    assert len(rows) == 2
    assert rows[1].temperature_c == 9.0 and rows[1].weather_code is None
    assert (rows[0].latitude, rows[0].timezone, rows[0].weather_code) == (40.4, "Europe/Madrid", 1)


def test_holidays_country_from_document_date_fallback_strict_types(spark):
    doc = ('{"source":"holidays","country_code":"ES","ingest_date":"2026-04-22","total_records":3,'
           '"holidays":[{"date":"2026-04-22","localName":"A","name":"Fiesta","countryCode":"FR",'
           '"fixed":true,"global":false,"launchYear":1992,"types":["Public"]},'
           '{"localName":"B","name":"NoDate","launchYear":"1992","fixed":"true"},'
           '{"date":"2026-04-22","localName":"A2","name":"Fiesta","countryCode":"ES"}]}')
    old = doc.replace('"ingest_date":"2026-04-22"', '"ingest_date":"2026-04-01"')
    out = curators.curate_holidays(parse_documents(docs_frame(spark, [doc, old]), HOLIDAYS_RAW))
    rows = {r.name: r for r in out.collect()}
    assert set(rows) == {"Fiesta", "NoDate"}
    f = rows["Fiesta"]
    assert f.country_code == "ES" and f.ingest_date == dt.date(2026, 4, 22)
    n = rows["NoDate"]
    # no date -> ingest date; strict schema: text "1992" and "true" do not land
    assert n.event_date in (dt.date(2026, 4, 22), dt.date(2026, 4, 1))
    assert n.launch_year is None and n.is_fixed is None


def test_flights_positional_decode_edges(spark):
    full = ('["abc123","  IBE12  ","Spain",1700000000,1700000100,-3.5,40.2,1000.5,false,'
            '230.1,90,-1.5,[1,2],1100,"1234",false,0]')
    short = '["def456","    ","France",1,2,3,4,5,true,6,7,8,null,9,"7700",true]'
    longer = ('["ghi789","X","P","1.0","2",3,4,5,"true",6,7,8,null,9,"1",false,2,"extra",99]')
    doc = ('{"time":1700000000,"snapshot_time":1700000200,"ingest_date":"2026-04-22",'
           f'"states":[{full},{short},{longer}]}}')
    out = curators.curate_flights(parse_documents(docs_frame(spark, [doc]), FLIGHTS_RAW))
    rows = {r.icao24: r for r in out.collect()}
    a = rows["abc123"]
    assert a.callsign == "IBE12" and a.time_position == 1700000000 and a.longitude == -3.5
    assert a.on_ground is False and a.geo_altitude == 1100.0 and a.position_source == 0
    assert (a.snapshot_time, a.source_time, a.event_date) == (1700000200, 1700000000,
                                                              dt.date(2026, 4, 22))
    d = rows["def456"]
    assert d.callsign == "" and d.position_source is None and d.spi is True
    g = rows["ghi789"]
    assert g.time_position == 1 and g.on_ground is True and g.position_source == 2


def test_flights_null_states_and_newest_contact_wins(spark):
    docs = docs_frame(spark, [
        '{"snapshot_time":5,"states":null}',
        '{"snapshot_time":5,"states":[["a","OLD",null,null,10],["a","NEW",null,null,20]]}'])
    out = curators.curate_flights(parse_documents(docs, FLIGHTS_RAW)).collect()
    assert [(r.icao24, r.callsign) for r in out] == [("a", "NEW")]
