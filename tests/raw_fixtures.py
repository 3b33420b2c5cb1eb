"""A tiny raw landing zone exercising the hard cases of every source family."""

from __future__ import annotations

import os

from statlake.layout import GemSource, Layout, StatsSource

from .xlsx_fixture import Inline, write_xlsx

GEM = (
    GemSource("wb_gdp_current", "gem/GDP current.xlsx", ("annual", "quarterly", "monthly")),
    GemSource("wb_unemployment", "gem/Unemployment.xlsx", ("annual", "monthly")),
)
STATS = (
    StatsSource("wb_gender_stats", "gender/data.csv", "gender/country.csv", "gender/series.csv"),
    StatsSource(
        "wb_ids_stats", "ids/data.csv", "ids/country.csv", "ids/series.csv",
        renames=(("series_name", "indicator_name"), ("series_code", "indicator_code")),
        country_renames=(("Code", "Country Code"), ("PPP survey years", "PPP survey year")),
        series_renames=(("code", "series_code"),),
        country_drop=(),
    ),
)
UNODC = (("unodc_econ_crime", "unodc/econ.xlsx"), ("unodc_func_justice", "unodc/justice.xlsx"))


def write_text(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def build(root: str) -> Layout:
    layout = Layout(root=root, gem=GEM, stats=STATS, unodc=UNODC, edstats_file="edstats/Edstats.csv")
    raw = layout.raw
    os.makedirs(raw("gem"), exist_ok=True)
    os.makedirs(raw("unodc"), exist_ok=True)

    header = [None, "St. Lucia", "Cote d'Ivoire", "Korea, Rep."]
    units = ["", "USD millions", "USD millions", "USD millions"]
    write_xlsx(raw(GEM[0].file), {
        "annual": [header, units, [1987.0, 1.5, None, 3.0], [1988.0, 2.5, 4.0, "n/a"]],
        "quarterly": [header, units, ["1987Q1", 1.0, 2.0, 3.0], ["1987Q5", 9.0, 9.0, 9.0]],
        "monthly": [header, units, ["1987M01", 1.25, None, None], ["1987M13", 5.0, 5.0, 5.0]],
    })
    write_xlsx(raw(GEM[1].file), {
        # an all-text column and a row whose period label is missing
        "annual": [[None, "St. Lucia", "Notes"], [Inline("%")], [2001, 7.5, "prelim"], [None, 8.5, "x"]],
        "monthly": [[None, "St. Lucia"], ["%"], ["2001M02", 6.5]],
    })

    title = ["UNODC statistics"]
    econ_header = ["Iso3_code", "Country", "Region", "Subregion", "Indicator", "Dimension", "Category",
                   "Sex", "Age", "Year", "VALUE", "Source"]
    write_xlsx(raw(UNODC[0][1]), {"data": [
        title, [],
        econ_header,
        ["AFG", "Afghanistan", "Asia", "Southern Asia", "Bribery", "Total", "Total", "Total", "Total", 2015, 12.5, "CTS"],
        ["XKX", "Kosovo", "Europe", "Southern Europe", "Bribery", "Total", "Total", "Total", "Total", 2016, 3, "CTS"],
        ["ZZZ", "Nowhere", "Oceania", "Polynesia", "Bribery", "Total", "Total", "Total", "Total", 2016, "n/a", "CTS"],
        [None, "Unknown", "Africa", "Northern Africa", "Bribery", "Total", "Total", "Total", "Total", 2016, 1, "CTS"],
    ]})
    justice_header = ["Region", "Iso3_code", "Country", "Subregion", "Indicator", "Dimension", "Category",
                      "Sex", "Age", "Year", "VALUE", "Source"]
    write_xlsx(raw(UNODC[1][1]), {"data": [
        title, ["(counts)"],
        justice_header,
        ["Europe", "XKX", "Kosovo", "Eastern Europe", "Prisoners", "Total", "Total", "Male", "Total", 2017, 100, "CTS"],
        ["Europe", "BEL", "Belgium", "Western Europe", "Prisoners", "Total", "Total", "Male", "Total", 2017, 200, "CTS"],
    ]})

    write_text(raw(STATS[0].data_file),
           '"Country Name","Country Code","Indicator Name","Indicator Code","1959","1960","2029","2030","Extra"\n'
           '"Afghanistan","AFG","Population","SP.POP","1","10","20","30","x"\n'
           '"Belgium","BEL","Population","SP.POP","2","11","","31","y"\n')
    write_text(raw(STATS[1].data_file),
           '"Country Name","Country Code","Series Name","Series Code","1960","1961"\n'
           '"Afghanistan, IS","AFG","Debt","DT.DOD","5","abc"\n'
           '"Afghanistan, IS","AFG","Population","SP.POP","7","8"\n')
    write_text(raw(STATS[0].country_file),
           'Country Code,Short Name,PPP survey year,Alternative conversion factor\n'
           'AFG,"Afghan\nistan",2011,x\nBEL,"Bel ""gium""",2017,\n')
    write_text(raw(STATS[1].country_file),
           'Code,Short Name,PPP survey years\nAFG,"Afghan\nistan",2011\n')
    write_text(raw(STATS[0].series_file),
           'Series Code,Topic,Indicator Name,Long definition\nSP.POP,Health,Population,"All people"\n')
    write_text(raw(STATS[1].series_file),
           'Code,Topic,Indicator Name\nDT.DOD,Debt,Debt stock\nSP.POP,Health,Population\n')
    write_text(raw(layout.edstats_file),
           'country_name,indicator_name,sex,urbanization,age,unit_type,unit_measure,YR1970,yr1999,YR2000\n'
           'Afghanistan,Enrolment,_T,_T,_T,NUM,PS,NA,1.,.5\n'
           'Afghanistan,Enrolment,F,_T,Y15T24,NUM,PS,-3e2,+1,abc\n'
           'Belgium,Enrolment,M,U,_T,NUM,PS,-999.999,,12\n'
           'Belgium,Enrolment,,U,_T,NUM,PS,1,2,3\n')
    return layout
