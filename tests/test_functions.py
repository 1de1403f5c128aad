"""Edge rows of the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions import detect, geo, numbers, replies, scoring, text, violations
from rivulet.operators import explain

C = F.col


def test_safe_float(values):
    cells = ["", "-", "N/A", None, " 7 ", "1e3", "abc", "1_000", "1d", "0x10", "NaN", "inf", "1e999", ".5", "5.", "-2.5",
             "1e-400", " 7\t"]
    assert values([(c,) for c in cells], "c string", numbers.safe_float(C("c"))) == [
        None, None, None, None, 7.0, 1000.0, None, None, None, None, None, None, None, 0.5, 5.0, -2.5, None, 7.0]


def test_minmax_avg_keeps_a_lone_value_unrounded(values):
    rows = [("1", "2"), (None, "3.33333"), ("-", "N/A"), (" 7 ", "1e3"), ("abc", "4"), ("1.00005", "1")]
    assert values(rows, "a string, b string", numbers.minmax_avg(C("a"), C("b"))) == [
        1.5, 3.33333, None, 503.5, 4.0, 1.0]


def test_type_helpers(values):
    rows = [("3.0",), ("3.9",), ("x",), ("  ",), (None,), ("-1.5",)]
    got = values(rows, "c string", numbers.to_int(C("c")), numbers.to_text(C("c")))
    assert got == [(3, "3.0"), (3, "3.9"), (None, "x"), (None, None), (None, None), (-1, "-1.5")]


def test_title_case_follows_every_non_letter(values):
    rows = [("U/S OF R.D.24B",), ("d/s o'brien's",), ("",), (None,), ("  goa 2nd  ",), ("écluse élan",)]
    assert values(rows, "c string", text.title_case(C("c"))) == [
        "U/S Of R.D.24B", "D/S O'Brien'S", "", "", "Goa 2Nd", "Écluse Élan"]


def test_stn_code(values):
    rows = [(None, ""), (None, None), (None, " Goa "), ("1444.0", "x"), ("26", "x"), ("GEN-490640", "x")]
    got = values(rows, "c string, l string", text.stn_code(C("c"), C("l")))
    assert got[0] == got[1] == "GEN-D41D8C"
    assert got[2].startswith("GEN-") and got[2] != got[0]
    assert got[3:] == ["1444", "26", "GEN-490640"]


def test_stems_and_slugs(values):
    rows = [("andhra_pradesh_2020_clean",), ("goa_2018",), ("karnataka",), ("karnataka_train",)]
    assert values(rows, "s string", text.slug_from_stem(C("s")), text.year_from_stem(C("s")),
                  text.state_name(text.slug_from_stem(C("s")))) == [
        ("andhra_pradesh", 2020, "Andhra Pradesh"), ("goa", 2018, "Goa"), ("karnataka", None, "Karnataka"),
        ("karnataka_train", None, "Karnataka Train")]
    assert values([("Jammu & Kashmir",)], "s string", text.state_slug(C("s"))) == ["jammu_and_kashmir"]


def test_split_list(values):
    assert values([(" a, b ,,c",), ("",), (None,)], "s string", text.split_list(C("s"))) == [["a", "b", "c"], [], []]


def test_normalize_param_and_parse(values):
    rows = [("BOD",), ("Low DO",), ("do",), ("dodo",), ("Nitrate-N",), ("Fecal coliform",), ("coliform",), ("pH",),
            ("phosphate",), ("p h",), ("None",), ("n/a",), ("",), (None,)]
    assert values(rows, "t string", violations.normalize_param(C("t"))) == [
        "BOD", "DO", "DO", None, "Nitrate", "Fecal Coliform", None, "pH", "pH", "pH", None, None, None, None]
    rows = [("Low DO, High BOD, do, x",), ("None",), (None,)]
    assert values(rows, "t string", violations.parse_violations(C("t"))) == [["DO", "BOD"], [], []]


def test_causes_are_distinct(values):
    got = values([(["BOD", "pH", "BOD", "?"],), ([],)], "p array<string>", violations.causes(C("p")), violations.impacts(C("p")))
    assert got[0][0] == [R.PARAMETER_KNOWLEDGE["BOD"][0], R.PARAMETER_KNOWLEDGE["pH"][0]]
    assert got[1] == ([], [])


def test_followup_questions(values):
    rows = [(["High BOD", "pH", "Nitrate"], "Unsafe"), (["TDS"], "Unsafe"), ([], "Unsafe"), ([], "Safe"), ([], None)]
    got = values(rows, "p array<string>, l string", violations.followup_questions(C("p"), C("l")))
    assert got[0] == ["What causes high BOD in rivers?", "What causes abnormal pH in water?", R.FOLLOWUP_DEFAULT[0]]
    assert got[1] == got[2] == R.FOLLOWUP_DEFAULT
    assert got[3] == R.FOLLOWUP_SAFE and got[4] == R.FOLLOWUP_GENERAL


def test_direction(values):
    rows = [(0.0, 0.0), (0.0, 1.0), (100.0, 104.0), (100.0, 105.0), (100.0, 90.0), (None, 1.0), (1.0, None)]
    lower = scoring.change_direction(C("a"), C("b"), False, "Improving", "Worsening", "Stable")
    higher = scoring.change_direction(C("a"), C("b"), True, "Improved", "Worsened", "N/A")
    assert values(rows, "a double, b double", lower, higher) == [
        ("Worsening", "Worsened"), ("Worsening", "Improved"), ("Stable", "Stable"), ("Worsening", "Improved"),
        ("Improving", "Worsened"), ("Stable", "N/A"), ("Stable", "N/A")]


def test_bands_and_buckets(values):
    rows = [(0.0,), (2.0,), (4.0,), (7.0,), (10.0,), (None,)]
    assert values(rows, "s double", scoring.score_band(C("s"))) == [
        "Clean", "Moderate", "Polluted", "Severely Polluted", "Severely Polluted", None]
    rows = [(19.9,), (20.0,), (50.0,), (None,)]
    assert values(rows, "s double", scoring.risk_bucket(C("s"))) == ["low", "medium", "high", None]


def test_limit_status(values):
    rows = [(4.9,), (5.0,), (None,)]
    assert values(rows, "v double", scoring.limit_status("do_avg", C("v"), 5.0), scoring.limit_status("bod_avg", C("v"), 3.0),
                  scoring.limit_status("ph_avg", C("v"), 1.0), scoring.limit_status("x", C("v"), None)) == [
        ("violation", "violation", "ok", "ok"), ("ok", "violation", "ok", "ok"), ("ok", "ok", "ok", "ok")]


def test_detect_schema(values):
    rows = [("Type water body river", False), ("TDS, river", False), ("Sea water", True), ("barrage", True), ("drain", True),
            ("drain", False), ("nitrate", True), ("", True), (None, False), ("research", False)]
    assert values(rows, "t string, c boolean", detect.detect_schema(F.upper(F.coalesce(C("t"), F.lit(""))), C("c"))) == [
        "coastal", "groundwater", "coastal", "river", "coastal", "river", "river", "coastal", "river", "coastal"]


def test_detect_water_body(values):
    rows = [("x", "any", "groundwater"), ("x", "any", "coastal"), ("x", "canal by the river", "river"), ("x", "canal", "river"),
            ("a_tank.pdf", "", "river"), ("x", "", "river"), ("x", None, "river"), ("stp.pdf", "", None), ("beach", "", None),
            ("borewell", "", None), ("x", "", None)]
    assert values(rows, "p string, t string, l string", detect.detect_water_body(C("p"), C("t"), C("l"))) == [
        "Groundwater", "Coastal", "River", "Canal", "Pond/Tank", "River", "River", "Drain/STP/WTP", "Coastal",
        "Groundwater", "Other"]


def test_invalid_report_name(values):
    rows = [("WQuality_River-Data-2020.pdf", 2020), ("wquality_river-data-2020.PDF", 2020), ("WQuality_River-Data-2020.pdf", 2021),
            ("WQuality_RiverXData-2020.pdf", 2020), ("xNWMP_DATA_2020.pdf", 2020), ("", 2020), (None, 2020)]
    assert values(rows, "f string, y int", detect.invalid_report_name(C("f"), C("y"))) == [
        False, False, True, True, True, True, True]


def test_geocode_texts(values):
    rows = [("River Kali U/S Road Bridge, Vammanjoor (near School)",), ("Borewell",), ("NH-4 Goa-Dam",), ("",)]
    simple = geo.geocode_simplify(C("l"))
    assert values(rows, "l string", simple) == ["kali vamanjoor", "", "goa", ""]
    rows = [(" Upper Kali Lake Town ", "upper kali lake town"), ("Borewell", ""), ("Goa", "goa")]
    got = values(rows, "l string, s string", geo.geocode_candidates(C("l"), F.lit("Goa"), C("s")))
    assert got[0] == ["upper kali lake town, Goa, India", "Upper Kali Lake Town, Goa, India", "kali lake town, Goa, India",
                      "lake town, Goa, India", "town, Goa, India"]
    assert got[1] == ["Borewell, Goa, India"]
    assert got[2] == ["goa, Goa, India", "Goa, Goa, India"]


def test_valid_coordinate(values):
    rows = [("90", "180"), ("90.1", "0"), ("NaN", "0"), (None, "0"), ("x", "1"), ("-90", "-180")]
    assert values(rows, "a string, b string", geo.valid_coordinate(C("a"), C("b"))) == [True, False, False, False, False, True]


def test_json_object(values):
    rows = [('```json\n{"a": 1}\n```',), ('Sure: {"a": {"b": 2}} ok',), ("{broken",), ("none",), ('{"a": 1}',), (None,), ("{x} {y}",)]
    assert values(rows, "t string", replies.json_object(C("t"))) == [
        '{"a": 1}', '{"a": {"b": 2}}', None, None, '{"a": 1}', None, None]


def test_response_list(values):
    rows = [('{"k": ["a", " ", 5, {"note": "n", "action": "go"}, {"first_step": "x", "n": 2, "y": null}]}',), ('{"k": "one"}',),
            ('{"k": null}',), ("{}",), ('{"k": []}',)]
    assert values(rows, "t string", replies.response_list(C("t"), "k")) == [
        ["a", "5", "go", "First Step: x; N: 2"], ["one"], [], [], []]


def test_response_items_of_any_type(values):
    rows = [('{"k": [true, 2.50, 1e3, ["x", {"b": 1, "a": 2}], {"z": {"q": [1]}, "a": false, "n": null}, {"action": "", "risk": 0, "note": 7}]}',),
            # Texts stay texts, also those that look like JSON.
            ('{"k": ["{\\"action\\": \\"x\\"}", "[1]", "true"]}',), ('{"k": "[not a list"}',), ('{"k": {"text": ["deep"]}}',),
            ('{"k": [{}, [], null, ""]}',), ('{"k": [{"action": {"x": 1}, "text": "t"}]}',), ("broken",), (None,)]
    assert values(rows, "t string", replies.response_list(C("t"), "k")) == [
        ["True", "2.5", "1000.0", '["x",{"a":2,"b":1}]', 'Z: {"q":[1]}; A: False', "7"],
        ['{"action": "x"}', "[1]", "true"], ["[not a list"], ['["deep"]'], ["[]"], ['{"x":1}'], [], []]


def test_insight_lists_of_any_type(spark):
    rows = [(1, '{"station_name": 7, "water_body_type": null, "violated_params": ["pH", 2, null, {"a": 1}], "recommended_measures": "[x]"}'),
            (2, '{"violated_params": {"a": 1}, "causes_of_pollution": [[1], true, " c "]}'), (3, None)]
    df = spark.createDataFrame(rows, "id int, json string").selectExpr(
        "*", "'S' AS station_name", "'River' AS water_body_type", "array(' BOD ') AS violated_params", "3 AS context_count")
    got = {r.id: (r.station_name, r.water_body_type, r.violated_params, r.causes_of_pollution, r.recommended_measures)
           for r in explain.normalize_insight(df).collect()}
    assert got == {1: ("7", "River", ["pH", "2", '{"a":1}'], [], []), 2: ("S", "River", ["BOD"], ["[1]", "True", "c"], []),
                   3: ("S", "River", ["BOD"], [], [])}


def test_title_case_keeps_every_character(values):
    cells = ["R.d.24b", "o'NEIL  st.\n\tnew town", "\x01 a\x01 b", "12ab-cd", "\x01", "", None]
    assert values([(c,) for c in cells], "c string", text.title_case(C("c"))) == [
        "R.D.24B", "O'Neil  St.\n\tNew Town", "\x01 A\x01 B", "12Ab-Cd", "\x01", "", ""]


def test_numbers_of_an_array(values):
    cells = [" 7 ", "\u20091e3\u2009", "1d", "NaN", "1e999", "1e-400", "-", "", None, ".5"]
    assert values([(cells,)], "c array<string>", numbers.to_doubles(C("c"))) == [
        [7.0, 1000.0, None, None, None, None, None, None, None, 0.5]]


def test_state_search_leaves_plain_rows_as_they_are(values):
    """The row search skips what is no letter or digit; characters beyond ASCII and cell ends keep their meaning."""
    from rivulet.functions import detect as D

    cells = F.split("t", "[|]")
    upper = D.row_upper(cells)
    letters = D.row_letters(upper)
    rows = [("1|x y|Tamil - Nadu|3",), ("KARNA|TAKA|1",), ("a😀b|é K.e.r.a.l.a😀|2",), ("KERA1LA",), ("J & K|GOA",), ("7.5|8.1",)]
    kept, at = zip(*values(rows, "t string", letters, D.cell_position(D.before_state(letters))))
    assert kept[0] == "1\x01X Y\x01TAMIL - NADU\x013" and kept[2] == "AB\x01KERALA\x012"
    assert list(at) == [2, None, 1, None, 0, None]
    text = F.upper(F.col("t"))
    got = values([("Goalpara",), ("Tamil  Nadu",), ("KERALA",), ("kar-nataka state",), ("none",), (None,)], "t string",
                 D.state_of_text(text, F.regexp_replace(text, "[^A-Z0-9]", "")))
    assert got == ["GOA", "TAMIL NADU", "KERALA", "KARNATAKA", None, None]
