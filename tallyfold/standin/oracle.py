"""Reference SQL for the registered queries, written apart from the Spark code.

Only the derivation of respondents and of the published-table counts is shared
text. Statistics are direct: every weight has its own pair of sums, the rest of
a group is summed from its members, nothing is subtracted.
"""

from __future__ import annotations

from tallyfold import codebook as cb
from tallyfold.operators.columns import snake
from tallyfold.sources.sheets import TABLE_TITLE_LINES
from tallyfold.standin import respondents as rs
from tallyfold.standin import tables as tb

R = rs.N_REPLICATES
METRICS = ", ".join(cb.METRICS)


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _values(name: str, column: str, values) -> str:
    return f"{name}({column}) as (values {', '.join(f'({chr(39)}{v}{chr(39)})' for v in values)})"


def r6(expression: str) -> str:
    return f"round({expression}, 6) + 0.0"


def _resp() -> str:
    items = {**rs.BASE, **{c: rs.answer(c) for c in rs.QUESTIONS}}
    items |= {f"w{r}": rs.weight_sql(r) for r in range(1, R + 1)}
    return ("resp as (select " + ", ".join(f"{sql} as {name}" for name, sql in items.items())
            + ", o_totalprice as w0 from orders join customer on o_custkey = c_custkey"
              " join nation on c_nationkey = n_nationkey)")


ANY_SPEND = " or ".join(f"spndsrc{n} >= 0" for n in range(1, 13))
RECODES = f"""
ind0 as (select *, 'wk' || week as week_num,
  case when rhispanic = 2 then 'Hispanic or Latino (may be of any race)'
       when rrace = 1 then 'White alone, not Hispanic' when rrace = 2 then 'Black alone, not Hispanic'
       when rrace = 3 then 'Asian alone, not Hispanic'
       when rrace = 4 then 'Two or more races + Other races, not Hispanic' end as hisp_rrace,
  case when 1 in (hlthins1, hlthins2, hlthins3, hlthins4, hlthins5, hlthins6) then 0.0::double
       when hlthins1 = 2 and hlthins2 = 2 and hlthins3 = 2 and hlthins4 = 2 and hlthins5 = 2 and hlthins6 = 2 then 1.0
       when hlthins7 = 1 then 1.0 end as uninsured,
  case when hlthins3 = 1 or hlthins4 = 1 or hlthins6 = 1 then 1.0::double
       when {' and '.join(f'hlthins{n} = -99' for n in range(1, 9))} then null
       when {' and '.join(f'hlthins{n} = -88' for n in range(1, 9))} then null else 0.0 end as insured_public,
  case wrkloss when 1 then 1.0::double when 2 then 0.0 end as inc_loss,
  case expctloss when 1 then 1.0::double when 2 then 0.0 end as expect_inc_loss,
  case when mortconf in (1, 2, 5) then 1.0::double when mortconf in (3, 4) then 0.0 end as payment_not_conf,
  case when tenure = 3 and rentcur = 1 then 1.0::double when tenure = 3 and rentcur = 2 then 0.0 end as rent_caughtup,
  case when tenure = 2 and mortcur = 1 then 1.0::double when tenure = 2 and mortcur = 2 then 0.0 end as mortgage_caughtup,
  case when curfoodsuf in (3, 4) then 1.0::double when curfoodsuf in (1, 2) then 0.0 end as food_insufficient,
  case when spndsrc2 = 1 then 1.0::double when {ANY_SPEND} then 0.0 end as spend_credit,
  case when spndsrc3 = 1 then 1.0::double when {ANY_SPEND} then 0.0 end as spend_savings,
  case when spndsrc5 = 1 then 1.0::double when {ANY_SPEND} then 0.0 end as spend_ui,
  case when spndsrc6 = 1 then 1.0::double when {ANY_SPEND} then 0.0 end as spend_stimulus,
  case when spndsrc8 = 1 then 1.0::double when {ANY_SPEND} then 0.0 end as spend_snap,
  case when anxious between 1 and 4 then anxious - 1 end as anxious_score,
  case when worry between 1 and 4 then worry - 1 end as worry_score,
  case when interest between 1 and 4 then interest - 1 end as interest_score,
  case when down between 1 and 4 then down - 1 end as down_score,
  case when expns_dif >= 3 then 1.0::double when expns_dif in (1, 2) then 0.0 end as expense_dif,
  case when tw_start = 1 then 1.0::double when tw_start in (2, 3) then 0.0 end as telework,
  case mh_notget when 1 then 1.0::double when 2 then 0.0 end as mentalhealth_unmet,
  case when evict in (1, 2) then 1.0::double when evict in (3, 4) then 0.0 end as eviction_risk,
  case when forclose in (1, 2) then 1.0::double when forclose in (3, 4) then 0.0 end as foreclosure_risk,
  case when tch_hrs in (1, 2) then 1.0::double when tch_hrs >= 3 then 0.0 end as learning_fewer
  from resp),
ind1 as (select *,
  case when tenure = 3 then payment_not_conf end as rent_not_conf,
  case when tenure = 2 then payment_not_conf end as mortgage_not_conf,
  case when anxious_score is null and worry_score is null then null
       when coalesce(anxious_score, 0) + coalesce(worry_score, 0) >= 3 then 1.0::double else 0.0 end as anxiety_signs,
  case when interest_score is null and down_score is null then null
       when coalesce(interest_score, 0) + coalesce(down_score, 0) >= 3 then 1.0::double else 0.0 end as depression_signs
  from ind0),
ind as (select *,
  case when anxiety_signs = 1 or depression_signs = 1 then 1.0::double
       when anxiety_signs is null and depression_signs is null then null else 0.0 end as depression_anxiety_signs
  from ind1)"""
IND = f"{_resp()}, {RECODES}"
EST = f"""{IND}, named as (select ind.*, n_name as state, {rs.METRO_SQL} as cbsa_title from ind
    left join nation on est_st = lpad(cast(n_nationkey as varchar), 2, '0')
    left join region on est_msa = cast(10000 + r_regionkey as varchar)),
est as (select * replace (case when tbirth_year < 1956 then null else uninsured end as uninsured,
    case when tbirth_year < 1956 then null else insured_public end as insured_public),
    case when hisp_rrace like '%Black alone%' then 'black' when hisp_rrace like '%Asian%' then 'asian'
         when hisp_rrace like '%Latino%' then 'hispanic' when hisp_rrace like '%White%' then 'white'
         when hisp_rrace like '%Two or%' then 'other' end as race from named)"""
PLACED = """placed as (select *, 'state' as geo_type, state as geography from {0} where state is not null
    union all select *, 'msa', cbsa_title from {0} where cbsa_title is not null)"""
PLACED_ALL = """placed as (select *, 'state' as geo_type, state as geography from {0}
    union all select *, 'msa', cbsa_title from {0})"""
NATION = "placed as (select *, 'national' as geo_type, 'US' as geography from {0})"
EVERYWHERE = PLACED[:-1] + " union all select *, 'national', 'US' from {0})"


def _sums(source: str, keys: str) -> str:
    """Answers and a pair of sums per weight, by keys and metric."""
    weights = ", ".join(f"w{r}" for r in range(R + 1))
    pairs = ", ".join(f"sum(w{r} * x) as a{r}, sum(w{r}) as b{r}" for r in range(R + 1))
    return (f"long as (unpivot (select {keys}, {weights}, {METRICS} from {source}) on {METRICS} into name metric value x),"
            f" cells as (select {keys}, metric, count(*) as n, {pairs} from long group by {keys}, metric)")


def _spread(term, factor: str = "2") -> str:
    return f"{factor} * sqrt((" + " + ".join(f"power({term(r)} - {term(0)}, 2)" for r in range(1, R + 1)) + f") / {R}.0)"


def _two_sides(within: str, item: str, race_var: str) -> str:
    """Own and rest sums of every cell, then the estimates of each weight for both: the rest is what comes before plus
    what comes after the cell among those with the same ``within``."""
    def rest(c: str) -> str:
        return f"coalesce(sum({c}) over ahead, 0) + coalesce(sum({c}) over behind, 0)"

    frames = ", ".join(f"{name} as (partition by {within} order by {item} nulls first rows between {frame})" for name, frame in (
        ("ahead", "unbounded preceding and 1 preceding"), ("behind", "1 following and unbounded following")))
    sums = ["n as n1", f"{rest('n')} as n0"] + [f"{s}{r} as {s}{r}_1, {rest(f'{s}{r}')} as {s}{r}_0" for r in range(R + 1) for s in ("a", "b")]
    thetas = ", ".join(f"a{r}_1 / b{r}_1 as t{r}, a{r}_0 / b{r}_0 as o{r}" for r in range(R + 1))
    return (f"sided as materialized (select week_num, geo_type, geography, metric, {race_var} as race_var, {', '.join(sums)} from cells window {frames}),"
            f" thetas as (select *, {thetas} from sided where geography is not null and race_var is not null)")


GROUPS = _values("groups", "race_var", cb.GROUPS)
GROUP_SIDES = _two_sides("week_num, geo_type, geography, metric", "race", "race")
TOTAL_SIDES = _two_sides("week_num, geo_type, metric", "geography", "'total'")
BOTH = "(n1 > 0 and n0 > 0)"


def _contrasts(races: str, name: str) -> str:
    """Contrast rows on the full grid, with the constants of an empty side."""
    def diff(r: int) -> str:
        return f"(o{r} - t{r})"

    return f"""{name} as (select g.metric, g.race_var, g.geo_type, g.geography, g.week_num,
      case when {BOTH} then t0 end as mean,
      case when {BOTH} then {_spread(lambda r: f't{r}')} else 0 end as se,
      case when {BOTH} then o0 end as other_mean,
      case when {BOTH} then {_spread(lambda r: f'o{r}', '1')} else 0 end as other_se,
      case when {BOTH} then o0 - t0 else 0 end as diff_mean,
      case when {BOTH} then {_spread(diff)} else 0 end as diff_se
      from (select distinct week_num, geo_type, geography, m.metric, r.race_var
            from (select distinct week_num, geo_type, geography from cells where geography is not null),
                 (select unnest([{_list(cb.METRICS)}]) as metric) m, {races} r) g
      left join thetas t on t.week_num = g.week_num and t.geo_type = g.geo_type and t.geography = g.geography
        and t.metric = g.metric and t.race_var = g.race_var)"""


TOTAL_RACE = "(select 'total' as race_var)"


def _group_contrasts(placed: str, name: str = "con") -> str:
    return (f"{placed.format('est')}, {_sums('placed', 'week_num, geo_type, geography, race')}, {GROUPS},"
            f" {GROUP_SIDES}, {_contrasts('groups', name)}")


def _total_contrasts(placed: str = PLACED, name: str = "con") -> str:
    return (f"{placed.format('est')}, {_sums('placed', 'week_num, geo_type, geography')},"
            f" {TOTAL_SIDES}, {_contrasts(TOTAL_RACE, name)}")


STATS = ("mean", "se", "other_mean", "other_se", "diff_mean", "diff_se")
STATS_OUT = ", ".join(f"{r6(s)} as {s}" for s in STATS)
CON_OUT = f"select metric, race_var, geo_type, geography, week_num, {STATS_OUT} from con"
SIGDIFF = ("case when diff_se = 0 then case when diff_mean <> 0 then 1.0::double end"
           " when abs(diff_mean / diff_se) > 1.96 then 1.0 else 0.0 end")
BOUNDS = {"mean": "mean", "se": "se", "moe_95": "se * 1.96", "moe_95_lb": "mean - se * 1.96",
          "moe_95_ub": "mean + se * 1.96"}
BOUNDS_OUT = ", ".join(f"{r6(sql)} as {name}" for name, sql in BOUNDS.items())
PUBLISH = f"geography, metric, week_num, race_var, {BOUNDS_OUT}, geo_type"
DATES = "dates(week_num, date_int) as (values " + ", ".join(f"('{w}', '{t}')" for w, t in cb.WEEK_DATES) + ")"


def _sub(ctes: str, select: str) -> str:
    return f"(with {ctes} {select})"


def _us_total(metrics) -> str:
    """National totals on their own: direct sums by week."""
    return (f"{_sums('est', 'week_num')}, ust as (select week_num, metric, a0 / b0 as mean,"
            f" {_spread(lambda r: f'(a{r} / b{r})')} as se from cells where metric in ({_list(metrics)}))")


def _feature() -> str:
    """The four families, each from its own pass, in the shape of the published rows."""
    kept = [m for m in cb.METRICS if m not in cb.REMOVED_TOTAL_METRICS]
    rows = f"select {PUBLISH}, {SIGDIFF} as sigdiff from con"
    removed = (f"select 'US' as geography, m.metric, week_num, 'total' as race_var, null::double as mean, 0.0::double as se,"
               f" 0.0::double as moe_95, null::double as moe_95_lb, null::double as moe_95_ub, 'national' as geo_type,"
               f" null::double as sigdiff from (select distinct week_num from est),"
               f" (select unnest([{_list(cb.REMOVED_TOTAL_METRICS)}]) as metric) m")
    us_total = (f"select 'US' as geography, metric, week_num, 'total' as race_var, {BOUNDS_OUT},"
                " 'national' as geo_type, null::double as sigdiff from ust")
    return "{groups} union all {totals} union all {us} union all {removed}".format(
        groups="select * from " + _sub(_group_contrasts(EVERYWHERE), rows),
        totals="select * from " + _sub(_total_contrasts(), rows),
        us="select * from " + _sub(_us_total(kept), us_total),
        removed=removed,
    )


def _national() -> str:
    kept = [m for m in cb.METRICS if m not in cb.REMOVED_TOTAL_METRICS]
    rows = f"select {PUBLISH}, {SIGDIFF} as sigdiff from con"
    full = _feature()
    head, removed = full.rsplit(" union all ", 1)
    us = ("select * from " + _sub(_us_total(kept),
          f"select 'US' as geography, metric, week_num, 'total' as race_var, {BOUNDS_OUT},"
          " 'national' as geo_type, null::double as sigdiff from ust"))
    return f"select * from {_sub(_group_contrasts(NATION), rows)} union all {us} union all {removed}"


def _answered() -> str:
    flags = ", ".join(f"case when {m} is null then 0.0::double else 1.0 end as answered_{m}" for m in cb.ANSWERED_METRICS)
    return (f"{IND}, flags as (select scram, week_num, hisp_rrace, inc_loss, {flags},"
            " case when tenure > 0 then 1.0::double when tenure <= 0 then 0.0 end as answered_tenure from ind)")


ANSWERED = [f"answered_{m}" for m in cb.ANSWERED_METRICS] + ["answered_tenure"]


def _rates(expression: str, names=ANSWERED) -> str:
    return ", ".join(f"{r6(expression.format(n))} as {n}" for n in names)


def _missing(columns) -> str:
    return ", ".join(f"avg(case when {c} is null then 1.0::double else 0.0 end) as {c}" for c in columns)


NUMERIC = ["tbirth_year", "rrace", "rhispanic", "pweight", *rs.QUESTIONS]
WEEKLY = (f"{IND}, long as (unpivot (select week, week_num, hisp_rrace, pweight, {METRICS} from ind)"
          f" on {METRICS} into name metric value x),"
          f" weekly as (select week, week_num, hisp_rrace, metric, count(*) as n,"
          f" {r6('sum(pweight * x) / sum(pweight)')} as mean from long group by week, week_num, hisp_rrace, metric)")


def _lines() -> str:
    """Published tables as lines: counts by area and group, laid out by position."""
    cells = ", ".join(f"sum({sql}) as {name}" for name, sql in tb.cells_sql().items())
    labels = ", ".join(f"'{t}'" for t in tb.GROUP_LABELS)
    parts = []
    for layout in tb.layouts():
        first, last = layout["weeks"]
        values = [f"{layout['table']}_{c}" for c in layout["columns"]]
        values += ["null::double"] * (cb.BENCHMARK_MAX_COLUMNS - len(values))
        parts.append(
            f"select '{layout['table']}' as table_name, week, geo_type, geography, hisp_rrace as variable,"
            f" list_position([{labels}], hisp_rrace)::int + 2 as line_no, {len(layout['columns'])} as n_cols, "
            + ", ".join(f"{v} as c{i}" for i, v in enumerate(values, start=1))
            + f" from summed where hisp_rrace is not null and week between {first} and {last}"
        )
    geo_type, week, geography, shift = tb.SHIFTED
    names = "geography " + " ".join(f"when '{title}' then '{name}'" for title, _, name in cb.METROS)
    return (f"{EST}, {EVERYWHERE.format('est')}, summed as (select week, geo_type, geography, hisp_rrace, {cells}"
            f" from placed group by week, geo_type, geography, hisp_rrace),"
            f" unshifted as ({' union all '.join(parts)}),"
            f" lines as (select * replace (case when table_name like 'food%' and geo_type = '{geo_type}' and week = {week}"
            f" and geography = '{geography}' then c4 + {shift} * c1 else c4 end as c4,"
            f" case {names} else geography end as geography) from unshifted)")


def _ratio_rows() -> str:
    """Shares written out by table and week."""
    early, late = "week < 34", "week >= 34"
    rows = [
        ("employ1", early, "inc_loss", "c2", "c1 - c4"),
        ("employ1", early, "expect_inc_loss", "c5", "c1 - c7"),
        ("employ1", late, "inc_loss", "c2", "c1 - c4"),
        *[(t, "true", "food_insufficient", "c5 + c4", "c1 - c6") for t in ("food2b", "food2", "food1")],
        *[(t, "true", "food_answered", "c1 - c6", "c1") for t in ("food2b", "food2", "food1")],
        ("housing2a", "true", "mortgage_not_conf", "c3 + c4 + c7", "c1 - c2 - c8"),
        ("housing2b", "true", "rent_not_conf", "c3 + c4 + c7", "c1 - c2 - c8"),
        ("housing1b", "week < 40", "rent_caughtup", "c3", "c1 - c2 - c5"),
        ("housing1b", "week >= 40", "rent_caughtup", "c2", "c1 - c5 - c4"),
        ("health2a", "true", "anxiety_signs", "c2 + c3 + c4", "c1 + c2 + c3 + c4"),
        ("health2b", "true", "depression_signs", "c7 + c8 + c9", "c6 + c7 + c8 + c9"),
        ("health3", "true", "insured_public", "c3", "c1"),
        ("health3", "true", "uninsured", "c4", "c4 + c1"),
        ("housing3b", "true", "eviction_risk", "c2 + c3", "c1 - c6"),
        ("transport1", "true", "telework", "c2", "c1 - c5"),
    ]
    race = " ".join(f"when '{label}' then '{g}'" for label, g in (
        (cb.HISPANIC_LABEL, "hispanic"), *zip(cb.RACE_LABELS.values(), ("white", "black", "asian", "other"))))
    titles = " ".join(f"when '{name}' then '{title}'" for title, _, name in cb.METROS)
    return "ratios as (" + " union all ".join(
        f"select table_name, 'wk' || week as week_num, case geography {titles} else geography end as geography, case variable {race} end as race_var,"
        f" '{metric}' as metric, {top} as numerator, {bottom} as denominator"
        f" from lines where table_name = '{table}' and {when}"
        for table, when, metric, top, bottom in rows
    ) + ")"


def _compared() -> str:
    when = " or ".join(
        f"(c.metric = '{m}' and cast(substr(c.week_num, 3) as int) between {a} and {b})"
        for m, (a, b) in cb.COMPARED_METRICS.items()
    )
    return (f"{_lines()}, {_ratio_rows()}, shares as (select week_num, geography, race_var, metric,"
            " sum(numerator) / nullif(sum(denominator), 0) as share from ratios group by all),"
            f" con as (select * from {_sub(_group_contrasts(EVERYWHERE, 'inner_con'), 'select * from inner_con')}),"
            " compared as (select c.metric, c.week_num, c.geography, c.race_var, round_even(c.mean, 4) as mean,"
            " round_even(s.share, 4) as benchmark_mean from con c join shares s on c.week_num = s.week_num"
            f" and c.geography = s.geography and c.race_var = s.race_var and c.metric = s.metric where ({when})"
            " and c.mean is not null and s.share is not null)")


COMPARED_OUT = ("select *, mean between benchmark_mean - 0.005 and benchmark_mean + 0.005 as within from compared")


def _slope(r: int) -> str:
    w, x = f"(b{r}_1 + b{r}_0)", f"(a{r}_1 + a{r}_0)"
    return f"({w} * a{r}_1 - b{r}_1 * {x}) / ({w} * b{r}_1 - b{r}_1 * b{r}_1) as s{r}"


def _cell_sides(placed: str = PLACED) -> str:
    """Cells of known groups beside what is left of their area: one pass for the sums, one window for the areas' totals."""
    names = [f"{s}{r}" for r in range(R + 1) for s in ("a", "b")]
    totals = ", ".join(f"sum({c}) over area as all_{c}" for c in ("n", *names))
    both = ", ".join(f"{c} as {c}_1, all_{c} - {c} as {c}_0" for c in names)
    thetas = ", ".join(f"a{r}_1 / b{r}_1 as t{r}, a{r}_0 / b{r}_0 as o{r}" for r in range(R + 1))
    return (f"{EST}, {placed.format('est')}, {_sums('placed', 'week_num, geo_type, geography, race')},"
            f" areas as (select *, {totals} from cells window area as (partition by week_num, geo_type, geography, metric)),"
            f" sided as (select week_num, geo_type, geography, metric, race as race_var, {both} from areas"
            f" where race in ({_list(cb.GROUPS)}) and n > 0 and all_n > n),"
            f" thetas as (select *, {thetas} from sided)")


SIDE_COLUMNS = "week_num, metric, geo_type, geography, race_var"


def _drawn() -> str:
    """Drawn cells of the last two weeks, and a pair of sums for each weight and side from their respondents."""
    weeks = [f"wk{w}" for w in range(rs.LAST_WEEK - 1, rs.LAST_WEEK + 1)]
    draws = ", ".join(_draw(values, name, f"qc|{name}", "slot") for name, values in (
        ("week_num", weeks), ("race_var", cb.GROUPS), ("metric", cb.METRICS)))
    picked = " union all ".join(
        f"(select geo_type, geography, geography as slot from places where geo_type = '{kind}' order by md5('qc|' || geo_type || '|' || geography),"
        f" geo_type, geography limit {n})" for kind, n in (("state", 7), ("msa", 3)))
    value = "case d.metric " + " ".join(f"when '{m}' then {m}" for m in cb.METRICS) + " end"
    sums = ["count(x) filter (own) as n1", "count(x) filter (not own) as n0"]
    for r in range(R + 1):
        sums += [f"sum(w{r} * x) filter (own) as a{r}_1, sum(w{r} * x) filter (not own) as a{r}_0",
                 f"sum(w{r}) filter (own) as b{r}_1, sum(w{r}) filter (not own) as b{r}_0"]
    thetas = ", ".join(f"a{r}_1 / b{r}_1 as t{r}, a{r}_0 / b{r}_0 as o{r}" for r in range(R + 1))
    return (f"{EST}, {EVERYWHERE.format('est')}, places as (select distinct geo_type, geography from placed),"
            f" slots as ({picked} union all select 'national', 'US', 'US' || i from range(10) t(i)),"
            f" drawn as (select distinct geo_type, geography, {draws} from slots),"
            f" met as (select d.*, p.race is not distinct from d.race_var as own, {value} as x,"
            f" {', '.join(f'p.w{r}' for r in range(R + 1))} from placed p join drawn d using (week_num, geo_type, geography)),"
            f" sided as (select week_num, geo_type, geography, metric, race_var, {', '.join(sums)} from met where x is not null group by all),"
            f" thetas as (select *, {thetas} from sided where n1 > 0 and n0 > 0)")


def _versus_total(placed: str = EVERYWHERE) -> str:
    def term(r: int) -> str:
        return f"d{r}"

    diffs = ", ".join(f"(a{r}_1 + a{r}_0) / (b{r}_1 + b{r}_0) - t{r} as d{r}" for r in range(R + 1))
    return (f"{EST}, {_group_contrasts(placed)}, vs as (select week_num, geo_type, geography, metric, race_var, {diffs}"
            f" from thetas where {BOTH}), out as (select week_num, metric, geo_type, geography, race_var,"
            f" {r6('d0')} as total_group, {r6(_spread(term))} as total_group_se from vs)")


def _draw(values, name: str, seed: str, key: str) -> str:
    return (f"list_extract([{_list(values)}], (('0x' || substr(md5('{seed}|' || {key}), 1, 8))::bigint"
            f" % {len(values)} + 1)::int) as {name}")


def _from(ctes: str, select: str) -> str:
    return f"with {ctes} {select}"


def sql() -> dict[str, str]:
    cols = ", ".join
    ind = lambda *names: _from(IND, f"select scram, week_num, {cols(names)} from ind")
    phase_columns = [c for c in rs.BASE if c != "pweight"] + list(rs.QUESTIONS)
    kept = [m for m in cb.METRICS if m not in cb.REMOVED_TOTAL_METRICS]
    published = f"select {PUBLISH}, {SIGDIFF} as sigdiff from con"
    weights = ", ".join(f"w{r} as pweight{r}" for r in range(1, R + 1))
    return {
        "scan_multi_period": _from(_resp(), "select week, count(*) as n_rows, count(wrkloss) as n_wrkloss,"
                                   " count(expctloss) as n_expctloss, count(spndsrc12) as n_spndsrc12 from resp group by week"),
        "harmonise_phases": _from(_resp(), f"select {cols(phase_columns)} from resp"),
        "latest_two_weeks": _from(_resp(), "select scram, week, wrkloss, pweight from resp"
                                  " where week >= (select max(week) - 1 from resp)"),
        "join_state_dim": _from(_resp(), "select scram, week, est_st, n_name as state,"
                                " replace(upper(n_name[1]) || lower(n_name[2:]), '_', ' ') as state_name"
                                " from resp left join nation on est_st = lpad(cast(n_nationkey as varchar), 2, '0')"),
        "join_msa_dim": _from(_resp(), f"select scram, week, est_msa, r_name || ' area' as csa_title, {rs.METRO_SQL} as cbsa_title"
                              " from resp left join region on est_msa = cast(10000 + r_regionkey as varchar)"),
        "join_replicate_weights": _from(_resp(), f"select scram, week, wrkloss, pweight, {weights} from resp"),
        "join_week_dates": _from(f"{_resp()}, {DATES}", "select scram, 'wk' || week as week_num, date_int"
                                 " from resp left join dates on 'wk' || week = dates.week_num"),
        "join_fanout_check": "select c_nationkey, count(*) as n_rows from customer group by c_nationkey having count(*) > 1",
        "join_row_balance": _from(_resp(), "select count(*) as n_before, count(*) as n_after, true as balanced from resp"),
        "dedupe_keep_first": "select c_nationkey, c_mktsegment, min(c_custkey) as c_custkey from customer group by all",
        "estimate_grid": _from(f"{EST}, {PLACED.format('est')}, {GROUPS}",
                               "select distinct week_num, geo_type, geography, m.metric, race_var from placed,"
                               f" (select unnest([{_list(cb.METRICS)}]) as metric) m, groups"),
        "recode_codes": ind("inc_loss", "expect_inc_loss", "payment_not_conf", "food_insufficient", "expense_dif",
                            "telework", "mentalhealth_unmet", "eviction_risk", "foreclosure_risk", "learning_fewer"),
        "derive_group": ind("hisp_rrace"),
        "recode_any_all": ind("uninsured", "insured_public"),
        "recode_conditional": ind("rent_not_conf", "mortgage_not_conf", "rent_caughtup", "mortgage_caughtup"),
        "recode_multi_response": ind("spend_credit", "spend_savings", "spend_ui", "spend_stimulus", "spend_snap"),
        "score_threshold": ind("anxious_score", "worry_score", "interest_score", "down_score", "anxiety_signs",
                               "depression_signs", "depression_anxiety_signs"),
        "answered_flags": _from(_answered(), f"select scram, week_num, {cols(ANSWERED)} from flags"),
        "split_metric_by_period": _from(IND, "select scram, week_num, case when week < 28 then inc_loss end as inc_loss,"
                                        " case when week >= 28 then inc_loss end as inc_loss_rv from ind"),
        "denominator_cut": _from(IND, "select scram, tbirth_year, case when tbirth_year >= 1956 then uninsured end as uninsured,"
                                 " case when tbirth_year >= 1956 then insured_public end as insured_public from ind"),
        "group_dummies": _from(IND, "select scram, hisp_rrace, " + cols(
            f"case when hisp_rrace like '%{mark}%' then 1.0::double else 0.0 end as {g}" for g, mark in cb.GROUP_MARKS.items()
        ) + " from ind"),
        "regex_extract_label": _from(_resp(), "select scram, 'tables/food_wk' || week || '.xlsx' as file_name,"
                                     " 'wk' || week as week_num from resp"),
        "week_labels": _from(_resp(), "select scram, 'wk' || week as week_num, lpad(week::varchar, 2, '0') as padded,"
                             " case when week < 22 then 2020 when week < 41 then 2021 else 2022 end as file_year,"
                             " case when week <= 21 then 2020 when week <= 41 then 2021 else 2022 end as table_year from resp"),
        "one_hot": _from(EST, "select scram, cbsa_title, " + cols(
            f"case when cbsa_title is not null then (cbsa_title = '{a}')::int end as cbsa_title_{snake(a)}"
            for a in rs.REGION_METROS) + " from est"),
        "stack_geographies": _from(f"{EST}, {PLACED.format('est')}",
                                   "select scram, week_num, geo_type, geography from placed"),
        "unpivot_metrics": _from(IND, " union all ".join(
            f"select scram, week_num, '{m}' as metric, {m} as x from ind" for m in cb.METRICS)),
        "pivot_metrics": _from(IND, "select week_num, hisp_rrace, " + cols(
            r6(f"sum(pweight * {m}) / sum(pweight) filter ({m} is not null)") + f" as {m}" for m in cb.METRICS
        ) + " from ind group by week_num, hisp_rrace"),
        "response_rate_by_group": _from(_answered(), f"select week_num, hisp_rrace, {_rates('avg({})')} from flags"
                                        " group by week_num, hisp_rrace"),
        "response_rate_with_total": _from(_answered(), f"select week_num, hisp_rrace, {_rates('avg({})')} from flags"
                                          f" group by week_num, hisp_rrace union all select week_num, 'Total',"
                                          f" {_rates('avg({})')} from flags group by week_num"),
        "race_mix_of_answerers": _from(
            f"{_answered()}, f2 as (select *, (hisp_rrace is not null)::int::double as answered_hisp_rrace from flags),"
            " sums as (select week_num, hisp_rrace, "
            + cols(f"coalesce(sum({n}), 0) as {n}" for n in [*ANSWERED, "answered_hisp_rrace"])
            + " from f2 group by week_num, hisp_rrace)",
            "select s.week_num, s.hisp_rrace, "
            + cols(r6(f"s.{n} / nullif(t.{n}, 0)") + f" as {n}" for n in [*ANSWERED, "answered_hisp_rrace"])
            + " from sums s join (select week_num, "
            + cols(f"sum({n}) as {n}" for n in [*ANSWERED, "answered_hisp_rrace"])
            + " from sums group by week_num) t on s.week_num = t.week_num"),
        "outcome_by_answered": _from(
            f"{_answered()}, known as (select * from flags where inc_loss is not null), labelled as (select week_num, hisp_rrace,"
            " 0 as lvl, inc_loss, " + cols(ANSWERED) + " from known union all select week_num, 'Total', 1, inc_loss, "
            + cols(ANSWERED) + " from known), vals as (select unnest([0.0::double, 1.0, null]) as answered)",
            "select week_num, hisp_rrace, answered, "
            + cols(r6(f"avg(inc_loss) filter ({n} is not distinct from answered)") + f" as {n}" for n in ANSWERED)
            + " from labelled, vals group by week_num, hisp_rrace, lvl, answered having "
            + " or ".join(f"count(*) filter ({n} is not distinct from answered) > 0" for n in ANSWERED)),
        "missing_share": _from(f"{_resp()}, s as (select 'wk' || week as week_num, {_missing(NUMERIC)} from resp group by week)",
                               "select week_num, " + cols(f"{r6(c)} as {c}" for c in NUMERIC) + " from s"),
        "all_missing_count": _from(f"{_resp()}, s as (select 'wk' || week as week_num, {_missing(NUMERIC)} from resp group by week)",
                                   "select week_num, (" + " + ".join(f"({c} = 1)::bigint" for c in NUMERIC)
                                   + ")::bigint as n_all_missing from s"),
        "missing_drift": _from(f"{_resp()}, s as (select week, {_missing(NUMERIC)} from resp group by week),"
                               f" l as (unpivot s on {cols(NUMERIC)} into name variable value pct)",
                               "select a.variable, a.pct as wk33, b.pct as wk34 from l a join l b on a.variable = b.variable"
                               " where a.week = 33 and b.week = 34 and (a.pct = 1 or b.pct = 1) and a.pct <> b.pct"),
        "drift_report": _from(f"{_resp()}, s as (select week, {_missing(NUMERIC)} from resp group by week),"
                              f" l as (unpivot s on {cols(NUMERIC)} into name variable value pct)",
                              f"select 'wk' || b.week as week_num, 'wk' || a.week as week_before, a.variable, {r6('a.pct')} as share_before,"
                              f" {r6('b.pct')} as share from l a join l b on a.variable = b.variable and a.week = b.week - 1"
                              " where b.week in (43, 46) and (a.pct = 1 or b.pct = 1) and a.pct <> b.pct"),
        "union_fill": _from(WEEKLY, "select week_num, hisp_rrace, metric, case when week >= 28 then n end as n, mean from weekly"),
        "append_idempotent": _from(WEEKLY, "select week_num, hisp_rrace, metric, n, case when week >= (select max(week) - 1"
                                   " from weekly) then mean else -1.0 end as mean from weekly"),
        "publication_order": _from(WEEKLY, "select *, row_number() over (order by metric nulls last, race_var nulls last, geography nulls last,"
                                   " week_rank nulls last) as row_rank from (select metric, week_num, case when hisp_rrace like '%Black alone%' then 'black'"
                                   " when hisp_rrace like '%Asian%' then 'asian' when hisp_rrace like '%Latino%' then 'hispanic'"
                                   " when hisp_rrace like '%White%' then 'white' when hisp_rrace like '%Two or%' then 'other' end"
                                   " as race_var, 'US' as geography, mean, week::int as week_rank from weekly)"),
        "seeded_sample": _from(f"{EST}, {PLACED.format('est')}, places as (select distinct geo_type, geography from placed),"
                               " chosen as (select * from places order by md5('qc|' || geo_type || '|' || geography),"
                               " geo_type, geography limit 10)",
                               f"select geo_type, geography, {_draw(cb.METRICS, 'metric', 'metric', 'geography')},"
                               f" {_draw(cb.GROUPS, 'race_var', 'group', 'geography')} from chosen"),
        "weighted_mean": _from(f"{EST}, long as (unpivot (select week_num, state, race, pweight, {METRICS} from est)"
                               f" on {METRICS} into name metric value x)",
                               f"select week_num, state, race, metric, count(*) as n,"
                               f" {r6('sum(pweight * x) / sum(pweight)')} as mean from long group by week_num, state, race, metric"),
        "replicate_means": _from(f"{EST}, {_sums('est', 'week_num')}", " union all ".join(
            f"select week_num, metric, {r} as replicate, {r6(f'a{r} / b{r}')} as mean from cells" for r in range(R + 1))),
        "replicate_se": _from(f"{EST}, {_sums('est', 'week_num, race')}",
                              f"select week_num, race, metric, n, {r6('a0 / b0')} as mean,"
                              f" {r6(_spread(lambda r: f'(a{r} / b{r})'))} as se from cells"),
        "contrast_group_vs_rest": _from(f"{EST}, {_group_contrasts(NATION)}", CON_OUT),
        "contrast_empty_domain": _from(f"{EST}, {_group_contrasts(PLACED)}", f"{CON_OUT} where mean is null"),
        "estimate_geo_by_group": _from(f"{EST}, {_group_contrasts(PLACED)}", CON_OUT),
        "estimate_geo_total": _from(f"{EST}, {_total_contrasts()}", CON_OUT),
        "estimate_geo_total_all_others": _from(f"{EST}, {_total_contrasts(PLACED_ALL)}", CON_OUT),
        "estimate_national_by_group": _from(f"{EST}, {_group_contrasts(NATION)}", published),
        "estimate_national_total": _from(f"{EST}, {_us_total(kept)}",
                                         f"select week_num, 'US' as geography, 'total' as race_var, {r6('mean')} as mean,"
                                         f" {r6('se')} as se, metric from ust"),
        "confidence_interval": _from(f"{EST}, {_sums('est', 'week_num, state')}, m as (select week_num, state, metric,"
                                     f" a0 / b0 as mean, {_spread(lambda r: f'(a{r} / b{r})')} as se from cells)",
                                     f"select week_num, state, metric, {BOUNDS_OUT} from m"),
        "significance_flag": _from(EST, "select geo_type, geography, metric, week_num, race_var, sigdiff from "
                                   + _sub(_group_contrasts(NATION), published)
                                   + " union all select geo_type, geography, metric, week_num, race_var, sigdiff from "
                                   + _sub(_total_contrasts(), published)),
        "removed_metric_rows": _from(_resp(), "select 'US' as geography, m.metric, week_num, 'total' as race_var,"
                                     " null::double as mean, 0.0::double as se, 0.0::double as moe_95, null::double as moe_95_lb,"
                                     " null::double as moe_95_ub, 'national' as geo_type, null::double as sigdiff"
                                     " from (select distinct 'wk' || week as week_num from resp),"
                                     f" (select unnest([{_list(cb.REMOVED_TOTAL_METRICS)}]) as metric) m"),
        "assemble_estimates": _from(f"{EST}, {DATES}, feature as ({_feature()})",
                                    "select f.*, date_int from feature f left join dates on f.week_num = dates.week_num"),
        "relabel_split_metric": _from(
            f"{EST}, {DATES}, feature as ({_national()}), dated as (select f.*, date_int from feature f"
            " left join dates on f.week_num = dates.week_num)",
            "select geography, metric, week_num, race_var, mean, se, moe_95, moe_95_lb, moe_95_ub, geo_type, sigdiff, date_int,"
            f" case when metric in ({_list(cb.REMOVED_TOTAL_METRICS)}) then 1.0::double else 0.0 end as var_removed"
            " from dated where metric <> 'inc_loss' union all"
            " select geography, 'inc_loss_rv', week_num, race_var, mean, se, moe_95, moe_95_lb, moe_95_ub, geo_type, sigdiff,"
            " date_int, 0.0 from dated where metric = 'inc_loss' union all"
            " select geography, metric, week_num, race_var, null, 0.0, 0.0, null, null, geo_type, null, date_int, 1.0"
            " from dated where metric = 'inc_loss'"),
        "expected_grid_count": _from(
            f"{EST}, {PLACED.format('est')}, p as (select n_name as place from nation union all select {rs.METRO_SQL} from region),"
            " hits as (select distinct geo_type, geography from placed where geography is not null)",
            f"select (select count(*) from p) * {21 * 6 * (rs.LAST_WEEK - rs.FIRST_WEEK + 1)}::bigint as n_found,"
            f" (select count(*) from p) * {21 * 6 * (rs.LAST_WEEK - rs.FIRST_WEEK + 1)}::bigint as n_expected,"
            " (select count(*) from hits) <= (select count(*) from p) as complete"),
        "benchmark_race_rows": _from(_lines(), "select table_name, week, geography, line_no, variable, "
                                     + cols(f"round(c{i}, 2) + 0.0 as c{i}" for i in range(1, cb.BENCHMARK_MAX_COLUMNS + 1))
                                     + " from lines"),
        "scan_sheets": _from(_lines(), f"select table_name, week, geography, line_no + {TABLE_TITLE_LINES} as line_no, n_cols, variable, "
                             + cols(f"round(c{i}, 2) + 0.0 as c{i}" for i in range(1, cb.BENCHMARK_MAX_COLUMNS + 1))
                             + " from lines"),
        "benchmark_ratios": _from(f"{_lines()}, {_ratio_rows()}",
                                  "select table_name, week_num, geography, race_var, metric, round(numerator, 2) + 0.0 as numerator,"
                                  f" round(denominator, 2) + 0.0 as denominator, {r6('numerator / nullif(denominator, 0)')} as share"
                                  " from ratios"),
        "qc_benchmark_compare": _from(_compared(), COMPARED_OUT),
        "qc_tolerance": _from(_compared(), f"select * from ({COMPARED_OUT}) where not within"),
        "qc_weighted_regression": _from(
            _cell_sides() + ", slopes as (select *, " + ", ".join(_slope(r) for r in range(R + 1)) + " from thetas), fitted as (select"
            f" {SIDE_COLUMNS}, s0 as slope, {_spread(lambda r: f's{r}')} as slope_se, o0 - t0 as diff_mean,"
            f" {_spread(lambda r: f'(o{r} - t{r})')} as diff_se from slopes)",
            f"select {SIDE_COLUMNS}, {r6('slope')} as slope, {r6('slope_se')} as slope_se, {r6('diff_mean')} as diff_mean,"
            f" {r6('diff_se')} as diff_se, abs(abs(slope) - abs(diff_mean)) < 1e-4 and abs(slope_se - diff_se) < 1e-4 as agree from fitted"),
        "qc_manual_se": _from(f"{EST}, {_group_contrasts(NATION)}",
                              f"select week_num, metric, geo_type, geography, race_var, {r6('-diff_mean')} as group_rest,"
                              f" {r6('diff_se')} as group_rest_se, {r6('diff_mean')} as diff_mean, {r6('diff_se')} as diff_se,"
                              " abs(t0_1 - t0_0 + diff_mean) < 1e-8 as agree from con"
                              " join (select week_num, metric, geo_type, geography, race_var, a0_1 / b0_1 as t0_1, a0_0 / b0_0 as t0_0"
                              f" from thetas where {BOTH}) using (week_num, metric, geo_type, geography, race_var)"
                              " where mean is not null"),
        "qc_manual_geo": _from(
            _cell_sides() + ", vs as (select *, " + ", ".join(
                f"(a{r}_1 + a{r}_0) / (b{r}_1 + b{r}_0) - t{r} as d{r}" for r in range(R + 1)) + " from thetas), out as (select"
            f" {SIDE_COLUMNS}, t0 - o0 as group_rest, {_spread(lambda r: f'(t{r} - o{r})')} as group_rest_se, o0 - t0 as diff_mean,"
            f" {r6('d0')} as total_group, {r6(_spread(lambda r: f'd{r}'))} as total_group_se from vs)",
            f"select {SIDE_COLUMNS}, {r6('group_rest')} as group_rest, {r6('group_rest_se')} as group_rest_se, {r6('diff_mean')} as diff_mean,"
            f" {r6('group_rest_se')} as diff_se, abs(group_rest + diff_mean) < 1e-8 as agree,"
            " case when total_group_se > 1e-3 then round(total_group / total_group_se, 4) + 0.0 end as total_group_t from out"),
        "cube_roll_up": _from(EST, f"select * from {_sub(_group_contrasts(NATION), CON_OUT)} union all select * from {_sub(_total_contrasts(), CON_OUT)}"),
        "qc_sampled_regression": _from(
            _drawn() + ", slopes as (select *, " + ", ".join(_slope(r) for r in range(R + 1)) + " from thetas)",
            f"select week_num, metric, geo_type, geography, race_var, {r6('s0')} as slope, {r6(_spread(lambda r: f's{r}'))} as slope_se,"
            f" {r6('o0 - t0')} as diff_mean, {r6(_spread(lambda r: f'(o{r} - t{r})'))} as diff_se, true as agree from slopes"),
        "qc_sampled_manual": _from(
            _drawn(), f"select week_num, metric, geo_type, geography, race_var, {r6('t0 - o0')} as group_rest,"
            f" {r6(_spread(lambda r: f'(t{r} - o{r})'))} as group_rest_se, {r6('o0 - t0')} as diff_mean,"
            f" {r6(_spread(lambda r: f'(o{r} - t{r})'))} as diff_se, true as agree from thetas"),
        "contrast_group_vs_total": _from(_versus_total(), "select * from out"),
    }
