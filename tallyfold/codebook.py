"""Names, codes, labels and week tables the results depend on.

Everything here is data. The values below have to be exactly these for the
published estimates to come out right, so they are listed as plain text in
their natural order.
"""

from __future__ import annotations

# The 21 indicators that get estimated.
METRICS = (
    "uninsured",
    "insured_public",
    "inc_loss",
    "expect_inc_loss",
    "rent_not_conf",
    "mortgage_not_conf",
    "food_insufficient",
    "depression_anxiety_signs",
    "spend_credit",
    "spend_ui",
    "spend_stimulus",
    "spend_savings",
    "spend_snap",
    "rent_caughtup",
    "mortgage_caughtup",
    "eviction_risk",
    "foreclosure_risk",
    "telework",
    "mentalhealth_unmet",
    "learning_fewer",
    "expense_dif",
)

# Indicators no longer asked in the last layout. The published
# national totals carry a constant row for the first list; the full output
# flags the second, which also has the relabelled income question.
REMOVED_TOTAL_METRICS = (
    "telework",
    "learning_fewer",
    "expect_inc_loss",
    "rent_not_conf",
    "mortgage_not_conf",
    "mentalhealth_unmet",
)
FLAGGED_REMOVED_METRICS = ("inc_loss", *REMOVED_TOTAL_METRICS)

# Indicators whose item response is reported.
ANSWERED_METRICS = (
    "uninsured",
    "insured_public",
    "inc_loss",
    "expect_inc_loss",
    "food_insufficient",
    "depression_anxiety_signs",
    "spend_credit",
    "spend_ui",
    "spend_stimulus",
    "spend_savings",
    "spend_snap",
    "telework",
    "mentalhealth_unmet",
    "expense_dif",
)

# Population groups. Label as it stands in the microdata.
RACE_LABELS = {
    1: "White alone, not Hispanic",
    2: "Black alone, not Hispanic",
    3: "Asian alone, not Hispanic",
    4: "Two or more races + Other races, not Hispanic",
}
HISPANIC_LABEL = "Hispanic or Latino (may be of any race)"

# Group name -> text that marks the group in its label.
GROUP_MARKS = {
    "black": "Black alone",
    "asian": "Asian",
    "hispanic": "Latino",
    "white": "White",
    "other": "Two or",
}
GROUPS = tuple(GROUP_MARKS)
TOTAL = "total"

# Questionnaire layouts. Weeks are inclusive; ``renames`` goes
# from the column of the file to the harmonised one; ``absent`` columns are
# added as nulls.
_SPEND_RENAMES = {f"spnd_src{n}": f"spndsrc{n}" for n in range(1, 13)}
PHASES = (
    {"weeks": (13, 27), "renames": {},
     "absent": ("spndsrc9", "spndsrc10", "spndsrc11", "spndsrc12")},
    {"weeks": (28, 33), "renames": {"wrklossrv": "wrkloss"},
     "absent": ("tw_start", "tch_hrs", "spndsrc10", "spndsrc11", "spndsrc12")},
    {"weeks": (34, 39), "renames": {"wrklossrv": "wrkloss", **_SPEND_RENAMES},
     "absent": ("expctloss", "tw_start", "tch_hrs")},
    {"weeks": (40, 42), "renames": {"wrklossrv": "wrkloss", **_SPEND_RENAMES},
     "absent": ("expctloss", "tw_start", "tch_hrs")},
    {"weeks": (43, 45), "renames": {"wrklossrv": "wrkloss", **_SPEND_RENAMES},
     "absent": ("expctloss", "tw_start", "tch_hrs")},
    {"weeks": (46, 48), "renames": {"wrklossrv": "wrkloss", **_SPEND_RENAMES},
     "absent": ("expctloss", "tw_start", "tch_hrs", "mortconf", "mh_notget")},
)
INCOME_SPLIT_WEEK = 28
AGE_CUT_BIRTH_YEAR = 1956

# The year a week's files are filed under. Microdata and
# published tables disagree on week 41.
MICRODATA_YEAR_STARTS = ((22, 2020), (41, 2021), (None, 2022))
BENCHMARK_YEAR_STARTS = ((22, 2020), (42, 2021), (None, 2022))

# Coded answer columns of the harmonised microdata.
ANSWER_COLUMNS = (
    "rrace", "rhispanic",
    *[f"hlthins{n}" for n in range(1, 9)],
    "wrkloss", "expctloss", "mortconf", "tenure", "rentcur", "mortcur",
    "evict", "forclose", "curfoodsuf", "expns_dif",
    *[f"spndsrc{n}" for n in range(1, 13)],
    "anxious", "worry", "interest", "down",
    "tw_start", "tch_hrs", "mh_notget",
)

# Dates of each week as displayed (en dash between them).
WEEK_DATES = (
    ("wk13", "8/19/20–8/31/20"),
    ("wk14", "9/2/20–9/14/20"),
    ("wk15", "9/16/20–9/28/20"),
    ("wk16", "9/30/20–10/12/20"),
    ("wk17", "10/14/20–10/26/20"),
    ("wk18", "10/28/20–11/9/20"),
    ("wk19", "11/11/20–11/23/20"),
    ("wk20", "11/25/20–12/7/20"),
    ("wk21", "12/9/20–12/21/20"),
    ("wk22", "1/6/21–1/18/21"),
    ("wk23", "1/20/21–2/1/21"),
    ("wk24", "2/3/21–2/15/21"),
    ("wk25", "2/17/21–3/1/21"),
    ("wk26", "3/3/21–3/15/21"),
    ("wk27", "3/17/21–3/29/21"),
    ("wk28", "4/14/21–4/26/21"),
    ("wk29", "4/28/21–5/10/21"),
    ("wk30", "5/12/21–5/24/21"),
    ("wk31", "5/26/21–6/7/21"),
    ("wk32", "6/9/21–6/21/21"),
    ("wk33", "6/23/21–7/5/21"),
    ("wk34", "7/21/21–8/2/21"),
    ("wk35", "8/4/21–8/16/21"),
    ("wk36", "8/18/21–8/30/21"),
    ("wk37", "9/1/21–9/13/21"),
    ("wk38", "9/15/21–9/27/21"),
    ("wk39", "9/29/21–10/11/21"),
    ("wk40", "12/1/21–12/13/21"),
    ("wk41", "12/29/21–1/10/22"),
    ("wk42", "1/26/22–2/7/22"),
    ("wk43", "3/2/22–3/14/22"),
    ("wk44", "3/30/22–4/11/22"),
    ("wk45", "4/27/22–5/9/22"),
    ("wk46", "6/1/22–6/13/22"),
    ("wk47", "6/29/22–7/11/22"),
)

# Metro areas: full title, short name, name in published tables.
METROS = (
    ("Atlanta-Sandy Springs-Roswell, GA", "Atlanta", "Atlanta_Metro_Area"),
    ("Boston-Cambridge-Newton, MA-NH", "Boston", "Boston_Metro_Area"),
    ("Chicago-Naperville-Elgin, IL-IN-WI", "Chicago", "Chicago_Metro_Area"),
    ("Dallas-Fort Worth-Arlington, TX", "Dallas/Fort Worth", "Dallas_Metro_Area"),
    ("Detroit-Warren-Dearborn, MI", "Detroit", "Detroit_Metro_Area"),
    ("Houston-The Woodlands-Sugar Land, TX", "Houston", "Houston_Metro_Area"),
    ("Los Angeles-Long Beach-Anaheim, CA", "Long Beach", "Los.Angeles_Metro_Area"),
    ("Miami-Fort Lauderdale-West Palm Beach, FL", "Miami/Fort Lauderdale", "Miami_Metro_Area"),
    ("New York-Newark-Jersey City, NY-NJ-PA", "New York", "New.York_Metro_Area"),
    ("Philadelphia-Camden-Wilmington, PA-NJ-DE-MD", "Philadelphia", "Philadelphia_Metro_Area"),
    ("Phoenix-Mesa-Scottsdale, AZ", "Phoenix", "Phoenix_Metro_Area"),
    ("Riverside-San Bernardino-Ontario, CA", "Riverside", "Riverside_Metro_Area"),
    ("San Francisco-Oakland-Hayward, CA", "San Francisco/Oakland", "San.Francisco_Metro_Area"),
    ("Seattle-Tacoma-Bellevue, WA", "Seattle", "Seattle_Metro_Area"),
    ("Washington-Arlington-Alexandria, DC-VA-MD-WV", "Washington DC", "Washington.DC_Metro_Area"),
)

# Layouts of the published tables, by position after the row
# label. ``weeks`` is inclusive, ``n_cols`` the number of value columns where
# the file decides between two forms. Each ratio is (metric, numerator, base).
_CONF = ("no_confidence", "slight_confidence", "moderate_confidence",
         "high_confidence", "payment_deferred", "did_not_respond_conf")
_NOT_CONF = "no_confidence + slight_confidence + payment_deferred"
_FOOD = ("total", "enough", "enough_but_not_wanted", "sometimes_not_enough",
         "often_not_enough", "did_not_report")
_FOOD_RATIOS = (
    ("food_insufficient", "often_not_enough + sometimes_not_enough", "total - did_not_report"),
    ("food_answered", "total - did_not_report", "total"),
)
_MORTGAGE_RATIOS = (("mortgage_not_conf", _NOT_CONF, "total - owned_free_clear - did_not_respond_conf"),)
_RENT_RATIOS = (("rent_not_conf", _NOT_CONF, "total - occup_no_rent - did_not_respond_conf"),)
_CAUGHTUP_RATIOS = (("rent_caughtup", "payment_caughtup_yes", "total - occup_no_rent - did_not_report"),)
BENCHMARK_LAYOUTS = (
    {"table": "employ1", "weeks": (13, 33), "n_cols": None,
     "columns": ("total", "income_loss", "no_income_loss", "did_not_report_loss",
                 "income_loss_next_4_wks", "no_income_next_4_wks", "did_not_report_next_4_wks"),
     "ratios": (("inc_loss", "income_loss", "total - did_not_report_loss"),
                ("expect_inc_loss", "income_loss_next_4_wks", "total - did_not_report_next_4_wks"))},
    {"table": "employ1", "weeks": (34, 48), "n_cols": None,
     "columns": ("total", "income_loss", "no_income_loss", "did_not_report"),
     "ratios": (("inc_loss", "income_loss", "total - did_not_report"),)},
    {"table": "food2b", "weeks": (13, 21), "n_cols": None, "columns": _FOOD, "ratios": _FOOD_RATIOS},
    {"table": "food2", "weeks": (22, 33), "n_cols": None, "columns": _FOOD, "ratios": _FOOD_RATIOS},
    {"table": "food1", "weeks": (34, 48), "n_cols": None, "columns": _FOOD, "ratios": _FOOD_RATIOS},
    {"table": "housing2a", "weeks": (13, 48), "n_cols": 9,
     "columns": ("total", "owned_free_clear", *_CONF, "did_not_respond_tenure"), "ratios": _MORTGAGE_RATIOS},
    {"table": "housing2a", "weeks": (13, 48), "n_cols": 10,
     "columns": ("total", "owned_free_clear", *_CONF, "renter_occupied", "did_not_respond_tenure"),
     "ratios": _MORTGAGE_RATIOS},
    {"table": "housing2b", "weeks": (13, 48), "n_cols": 9,
     "columns": ("total", "occup_no_rent", *_CONF, "did_not_respond_tenure"), "ratios": _RENT_RATIOS},
    {"table": "housing2b", "weeks": (13, 48), "n_cols": 10,
     "columns": ("total", "occup_no_rent", *_CONF, "owner_occupied", "did_not_respond_tenure"),
     "ratios": _RENT_RATIOS},
    {"table": "housing1b", "weeks": (13, 39), "n_cols": None,
     "columns": ("total", "occup_no_rent", "payment_caughtup_yes", "payment_caughtup_no",
                 "did_not_report", "did_not_report_tenure"),
     "ratios": _CAUGHTUP_RATIOS},
    {"table": "housing1b", "weeks": (40, 48), "n_cols": None,
     "columns": ("total", "payment_caughtup_yes", "payment_caughtup_no", "did_not_report",
                 "occup_no_rent", "did_not_report_tenure"),
     "ratios": _CAUGHTUP_RATIOS},
    {"table": "health2a", "weeks": (13, 48), "n_cols": None,
     "columns": ("anxious_not_at_all", "anxious_several", "anxious_halfmore", "anxious_nearlyall",
                 "anxious_no_response",
                 "worry_not_at_all", "worry_several", "worry_halfmore", "worry_nearlyall",
                 "worry_no_response"),
     "ratios": (("anxiety_signs", "anxious_several + anxious_halfmore + anxious_nearlyall",
                 "anxious_not_at_all + anxious_several + anxious_halfmore + anxious_nearlyall"),)},
    {"table": "health2b", "weeks": (13, 48), "n_cols": None,
     "columns": ("interest_not_at_all", "interest_several", "interest_halfmore", "interest_nearlyall",
                 "interest_no_response",
                 "down_not_at_all", "down_several", "down_halfmore", "down_nearlyall",
                 "down_no_response"),
     "ratios": (("depression_signs", "down_several + down_halfmore + down_nearlyall",
                 "down_not_at_all + down_several + down_halfmore + down_nearlyall"),)},
    {"table": "health3", "weeks": (13, 48), "n_cols": None,
     "columns": ("total_insured", "private", "public", "uninsured", "not_reported"),
     "ratios": (("insured_public", "public", "total_insured"),
                ("uninsured", "uninsured", "uninsured + total_insured"))},
    {"table": "housing3b", "weeks": (13, 48), "n_cols": None,
     "columns": ("total", "very_likely", "somewhat_likely", "not_very_likely", "not_likely", "did_not_report"),
     "ratios": (("eviction_risk", "very_likely + somewhat_likely", "total - did_not_report"),)},
    {"table": "transport1", "weeks": (13, 48), "n_cols": None,
     "columns": ("total", "telework_start_yes", "telework_start_no", "no_change", "did_not_report"),
     "ratios": (("telework", "telework_start_yes", "total - did_not_report"),)},
)
BENCHMARK_MAX_COLUMNS = 10

# Indicators compared with published tables, with the weeks
# (inclusive) that are compared, and the tolerance on shares rounded to 4.
COMPARED_METRICS = {
    "food_insufficient": (13, 47),
    "rent_caughtup": (13, 47),
    "inc_loss": (13, 47),
    "eviction_risk": (13, 47),
    "telework": (13, 27),
}
COMPARE_TOLERANCE = 0.005
Z_95 = 1.96

# Column notes published beside the data.
ESTIMATE_DICTIONARY = (
    ("geography", "string", "name of the area"),
    ("metric", "string", "name of the indicator"),
    ("week_num", "string", "survey week, wk and its number"),
    ("race_var", "string", "population group, or total"),
    ("mean", "float", "weighted share; null where nobody in the cell or in its complement answered"),
    ("se", "float", "standard error from the replicate weights; 0 beside a null mean"),
    ("moe_95", "float", "1.96 times se"),
    ("moe_95_lb", "float", "mean minus moe_95"),
    ("moe_95_ub", "float", "mean plus moe_95"),
    ("geo_type", "string", "state, msa or national"),
    ("sigdiff", "bool", "1 if the cell differs from its complement: for a group the other groups of the "
                        "same area, for a total the other areas of the same type; null for the national total"),
)
INDICATOR_NOTES = (
    ("hisp_rrace", "race and Hispanic origin in five categories; Hispanic origin takes precedence"),
    ("uninsured", "1 if none of the six insurance kinds is held; Indian Health Service alone counts as uninsured"),
    ("insured_public", "1 if covered by Medicare, Medicaid or veterans' insurance"),
    ("inc_loss", "1 if the household lost employment income, question asked before week 28"),
    ("inc_loss_rv", "1 if the household lost employment income in the last four weeks, asked from week 28"),
    ("expect_inc_loss", "1 if a loss of employment income is expected; asked through week 33"),
    ("payment_not_conf", "1 if not confident of the next housing payment, or payment deferred; asked through week 45"),
    ("rent_not_conf", "payment_not_conf among renters"),
    ("mortgage_not_conf", "payment_not_conf among owners with a mortgage"),
    ("rent_caughtup", "1 if caught up on rent, among renters"),
    ("mortgage_caughtup", "1 if caught up on the mortgage, among owners with one"),
    ("food_insufficient", "1 if there was sometimes or often not enough to eat"),
    ("spend_savings", "1 if savings or sold assets paid for spending"),
    ("spend_credit", "1 if credit cards or loans paid for spending"),
    ("spend_ui", "1 if unemployment benefits paid for spending"),
    ("spend_stimulus", "1 if stimulus payments paid for spending"),
    ("spend_snap", "1 if food assistance paid for spending"),
    ("anxious_score", "0 to 3 by frequency of feeling anxious"),
    ("worry_score", "0 to 3 by frequency of uncontrolled worry"),
    ("interest_score", "0 to 3 by frequency of little interest"),
    ("down_score", "0 to 3 by frequency of feeling down"),
    ("anxiety_signs", "1 if anxious_score and worry_score add up to 3 or more"),
    ("depression_signs", "1 if interest_score and down_score add up to 3 or more"),
    ("depression_anxiety_signs", "1 if either of the two signs shows"),
    ("expense_dif", "1 if usual household expenses were hard to pay"),
    ("telework", "1 if someone replaced in-person work by telework; asked through week 27"),
    ("mentalhealth_unmet", "1 if needed counselling was not received; asked through week 45"),
    ("eviction_risk", "1 if eviction within two months is likely"),
    ("foreclosure_risk", "1 if foreclosure within two months is likely"),
    ("learning_fewer", "1 if students learn fewer hours than before; asked through week 27"),
    ("week_num", "survey week, wk and its number"),
    ("state", "two-letter state"),
    ("state_name", "state name"),
    ("csa_title", "combined statistical area of the metro area"),
    ("cbsa_title", "metro area"),
)
RESPONSE_NOTES = (
    ("hisp_rrace", "population group, or Total"),
    *((f"answered_{m}", f"share of respondents with an answer for {m}") for m in ANSWERED_METRICS),
    ("answered_tenure", "share of respondents with an answer on tenure; stands in for the housing indicators"),
    ("week_num", "survey week, wk and its number"),
)
