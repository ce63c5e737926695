import datetime as dt
import random
from collections import Counter

import pytest

from panelforge.plans import trades
from panelforge.plans.bonds import bonds_outstanding
from panelforge.sources.schemas import DRIVER
from panelforge.workload import bonds
from panelforge.workload.catalog import REGISTRY
from panelforge.workload.tables import Tables

SCHEMA = (
    "cusip_id string, msg_seq_nb string, orig_msg_seq_nb string, entrd_vol_qt double, rptd_pr double, yld_pt double, rpt_side_cd string, "
    "cntra_mp_id string, trd_exctn_dt date, trd_exctn_tm string, trd_rpt_dt date, trd_rpt_tm string, pr_trd_dt date, trc_st string, "
    "asof_cd string, wis_fl string, days_to_sttl_ct string, stlmnt_dt date, spcl_trd_fl string"
)
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
BEFORE, AFTER = dt.date(2011, 5, 2), dt.date(2013, 5, 2)


def report(**given):
    base = dict(
        cusip_id="B", msg_seq_nb="1", orig_msg_seq_nb=None, entrd_vol_qt=1.0, rptd_pr=100.0, yld_pt=1.0, rpt_side_cd="B", cntra_mp_id="C",
        trd_exctn_dt=BEFORE, trd_exctn_tm="10:00:00", trd_rpt_dt=BEFORE, trd_rpt_tm="11:00:00", pr_trd_dt=None, trc_st="T", asof_cd=None,
        wis_fl="N", days_to_sttl_ct=None, stlmnt_dt=None, spcl_trd_fl=None,
    )
    return base | given


def table(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], SCHEMA)


def clean_by_hand(rows):
    """Plain-Python cleaning of a small list of reports; a key with a missing part matches nothing."""
    cut = dt.date(2012, 2, 6)
    same = ("cusip_id", "msg_seq_nb", "entrd_vol_qt", "rptd_pr", "rpt_side_cd", "cntra_mp_id", "trd_exctn_dt", "trd_exctn_tm")
    key = lambda r: tuple(r[c] for c in same)
    original = lambda r: tuple(r["orig_msg_seq_nb"] if c == "msg_seq_nb" else r[c] for c in same)
    late, early = [r for r in rows if r["trd_rpt_dt"] >= cut], [r for r in rows if r["trd_rpt_dt"] < cut]
    dropped = {key(r) for r in late if r["trc_st"] in "XC"} | {original(r) for r in late if r["trc_st"] == "Y"}
    out = [r for r in late if r["trc_st"] in "TR" and (None in key(r) or key(r) not in dropped)]
    cancelled = {original(r) for r in early if r["trc_st"] == "C"}
    kept = [r for r in early if r["trc_st"] == "T" and (None in key(r) or key(r) not in cancelled)]
    waiting = [r for r in early if r["trc_st"] == "W"]
    own = lambda r: (r["cusip_id"], r["trd_exctn_dt"], r["msg_seq_nb"])
    target = lambda r: (r["cusip_id"], r["trd_exctn_dt"], r["orig_msg_seq_nb"])
    while waiting:
        present = {own(r) for r in kept}
        ready = [r for r in waiting if r["orig_msg_seq_nb"] is not None and target(r) in present]
        if not ready:
            break
        waiting = [r for r in waiting if r not in ready]
        hit = {target(r) for r in ready}
        kept = [r for r in kept if own(r) not in hit] + ready
    terms = lambda r: tuple(r[c] for c in ("cusip_id", "trd_exctn_dt", "entrd_vol_qt", "rptd_pr", "rpt_side_cd", "cntra_mp_id"))
    budget = Counter(terms(r) for r in kept if r["asof_cd"] == "R")
    rest = [n for n in NAMES if n not in ("trd_exctn_tm", "trd_rpt_dt", "trd_rpt_tm", "msg_seq_nb")]
    order = ["trd_exctn_tm", "trd_rpt_dt", "trd_rpt_tm", "msg_seq_nb", *rest]
    for r in sorted(kept, key=lambda r: [(r[c] is None, r[c] if r[c] is not None else 0) for c in order]):
        if r["asof_cd"] in ("R", "X", "D"):
            continue
        if budget[terms(r)] > 0:
            budget[terms(r)] -= 1
        else:
            out.append(r)
    match = lambda r: tuple(r[c] for c in ("cusip_id", "trd_exctn_dt", "entrd_vol_qt", "rptd_pr"))
    sells = {match(r) for r in out if r["cntra_mp_id"] == "D" and r["rpt_side_cd"] == "S"}
    out = [r for r in out if r["cntra_mp_id"] == "C" or (r["cntra_mp_id"] == "D" and (r["rpt_side_cd"] == "S" or match(r) not in sells))]
    return [
        r for r in out
        if (r["days_to_sttl_ct"] is None or float(r["days_to_sttl_ct"]) <= 7)
        and (r["stlmnt_dt"] is None or (r["stlmnt_dt"] - r["trd_exctn_dt"]).days <= 7)
        and r["wis_fl"] == "N" and r["spcl_trd_fl"] in (None, "") and r["asof_cd"] in (None, "")
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_whole_cleaning_against_plain_python(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(700):
        executed = rng.choice([BEFORE, BEFORE, AFTER])
        rows.append(report(
            cusip_id=rng.choice(["A", "A", "B"]), msg_seq_nb=str(rng.randint(1, 30)), orig_msg_seq_nb=rng.choice([None, *map(str, range(1, 31))]),
            rptd_pr=rng.choice([99.0, 100.0]), rpt_side_cd=rng.choice("BS"), cntra_mp_id=rng.choice("CCDE"), trd_exctn_dt=executed,
            trd_exctn_tm=rng.choice(["09:00:00", "10:00:00", None]), trd_rpt_dt=executed, trc_st=rng.choice("TTTTTTWWCXYR"),
            asof_cd=rng.choice([None, None, None, "R", "X", "", "A"]), stlmnt_dt=rng.choice([None, executed + dt.timedelta(3), executed + dt.timedelta(9)]),
            days_to_sttl_ct=rng.choice([None, "3", "9"]), wis_fl=rng.choice("NNNY"), yld_pt=float(rng.randint(1, 5)),
        ))
    got = trades.clean_trades(table(spark, rows), "2010-01-01", "2014-01-01")
    expected = Counter(tuple(r[c] for c in trades.OUTPUT_COLUMNS) for r in clean_by_hand(rows))
    assert Counter(tuple(r) for r in got.collect()) == expected and expected


def test_correction_chain_and_unmatched(spark):
    rows = [report(msg_seq_nb="1"), report(msg_seq_nb="2", orig_msg_seq_nb="1", trc_st="W"), report(msg_seq_nb="3", orig_msg_seq_nb="2", trc_st="W"),
            report(msg_seq_nb="9", orig_msg_seq_nb="8", trc_st="W")]
    scoped = table(spark, rows)
    got = trades.pre_corrections(trades.pre_cancel(scoped), scoped).collect()
    assert [r["msg_seq_nb"] for r in got] == ["3"]


def test_a_long_chain_takes_few_tables(spark, monkeypatch):
    """A thousand links: the last correction alone survives, and pointers reach it in a handful of written tables."""
    written = []
    plain = trades.materialize
    monkeypatch.setattr(trades, "materialize", lambda df, name="stage": written.append(name) or plain(df, name))
    rows = [report(msg_seq_nb="0")] + [report(msg_seq_nb=str(k + 1), orig_msg_seq_nb=str(k), trc_st="W") for k in range(1000)]
    rows += [report(cusip_id="C", msg_seq_nb="7", orig_msg_seq_nb="6", trc_st="W")]  # corrects nothing that is there
    scoped = table(spark, rows)
    got = trades.pre_corrections(trades.pre_cancel(scoped), scoped).collect()
    assert [(r["cusip_id"], r["msg_seq_nb"]) for r in got] == [("B", "1000")]
    assert len(written) <= 11


@pytest.mark.parametrize("seed", range(4))
def test_levels_of_any_graph_of_corrections(spark, seed):
    """Chains that fork, meet and run in circles: rounds equal those of walking link by link."""
    rng = random.Random(seed)
    links = {(rng.randrange(60), rng.randrange(60)) for _ in range(70)} | {(100 + k, 101 + k) for k in range(30)} | {(130, 100), (120, 125), (5, 100)}
    start = set(rng.sample(range(60), 6))
    reports = [report(msg_seq_nb=str(k)) for k in start] + [report(msg_seq_nb=str(b), orig_msg_seq_nb=str(a), trc_st="W") for a, b in links]
    scoped = table(spark, reports)
    found = trades.correction_levels(trades.pre_cancel(scoped), scoped.where("trc_st = 'W'")).collect()
    corrected = {a for a, _ in links}
    level, frontier, expected = 0, start & corrected, {}
    while frontier:
        expected |= {k: level for k in frontier}
        level += 1
        frontier = {b for a, b in links if a in frontier and b in corrected and b not in expected}
    assert {int(r["key"]): r["level"] for r in found} == expected and len(found) == len(expected)


def test_correction_cycle_ends(spark):
    rows = [report(msg_seq_nb="1"), report(msg_seq_nb="2", orig_msg_seq_nb="1", trc_st="W"), report(msg_seq_nb="1", orig_msg_seq_nb="2", trc_st="W", yld_pt=7.0)]
    scoped = table(spark, rows)
    got = trades.pre_corrections(trades.pre_cancel(scoped), scoped).collect()
    assert [(r["msg_seq_nb"], r["yld_pt"]) for r in got] == [("1", 7.0)]


def test_reversals_among_many_copies(spark, monkeypatch):
    monkeypatch.setattr(trades, "COPIES_PER_ROW", 16)
    rows = [report() for _ in range(100)] + [report(asof_cd="R") for _ in range(2)] + [report(rptd_pr=50.0)]
    got = Counter(r["rptd_pr"] for r in trades.pre_reversals(table(spark, rows)).collect())
    assert got == {100.0: 98, 50.0: 1}


def test_cleaned_ids_are_input_ids(spark):
    rows = [report(cusip_id=c, msg_seq_nb=str(i)) for i, c in enumerate("ABAB")]
    only = spark.createDataFrame([("A",)], "cusip_id string")
    got = trades.clean_trades(table(spark, rows), "2010-01-01", "2014-01-01", only)
    assert [r["cusip_id"] for r in got.collect()] == ["A", "A"]


def test_scope_drops_what_lies_outside(spark):
    days = [dt.date(2009, 12, 31), dt.date(2010, 1, 1), BEFORE, dt.date(2013, 12, 31), dt.date(2014, 1, 1), None]
    got = trades.scope(table(spark, [report(trd_exctn_dt=d) for d in days]), "2010-01-01", "2013-12-31").collect()
    assert sorted(r["trd_exctn_dt"] for r in got) == days[1:4]


def test_queries_take_the_reports_of_all_quarters(spark, tmp_path):
    """Items shipped from 1995 to 2001, the whole calendar of the orders: every report is in the scope of the cleaning queries."""
    rng = random.Random(3)
    shipped = [dt.datetime(1995, 1, 2) + dt.timedelta(days=d) for d in range(0, 2499, 7)] + [dt.datetime(2001, 11, 4)]
    rows = []
    for i, day in enumerate(shipped * 3):
        flag, status = rng.choice(["AF", "AF", "RF", "NF", "NO", "RO"])
        rows.append((rng.randrange(40), rng.randrange(48), rng.randrange(12), rng.randint(1, 4), float(rng.randint(1, 3)), 10.0, 0.0, 0.01 * (i % 5), flag, status, day))
    spark.createDataFrame(rows, DRIVER["lineitem"]).write.parquet(str(tmp_path / "lineitem.parquet"))
    reports = [r.asDict() for r in Tables(spark, str(tmp_path)).trades.collect()]
    assert REGISTRY["trade_scope"].run(spark, str(tmp_path)).count() == len(reports) == len(rows)
    got = REGISTRY["clean_trades"].run(spark, str(tmp_path)).collect()
    shown = lambda r: tuple(round(r[c], 6) if c == "yld_pt" else r[c] for c in trades.OUTPUT_COLUMNS)
    assert Counter(shown(r) for r in got) == Counter(shown(r) for r in clean_by_hand(reports))
    executed = [r["trd_exctn_dt"] for r in got]
    assert min(executed) < dt.date(2010, 3, 1) and max(executed) > dt.date(2013, 3, 31)


def test_whole_reports_are_written_twice_at_most(spark, tmp_path, monkeypatch):
    """Reversals and agency trades write no copy of all reports; whole rows are written after cancellations and with their reversals."""
    wide, plain = [], trades.materialize

    def noted(df, name="stage"):
        if set(trades.COLUMNS) <= set(df.columns):
            wide.append(name)
        return plain(df, name)

    monkeypatch.setattr(trades, "materialize", noted)
    monkeypatch.setattr(bonds, "materialize", noted)
    flags = ["AF", "AF", "RF", "NF", "RO"]
    rows = [(i % 40, i % 48, i % 12, i % 4 + 1, 1.0, 10.0, 0.0, 0.01, *flags[i % 5], dt.datetime(1995, 1, 2) + dt.timedelta(days=i % 2400)) for i in range(1200)]
    spark.createDataFrame(rows, DRIVER["lineitem"]).write.parquet(str(tmp_path / "lineitem.parquet"))
    for name in ("pre_reversals", "agency", "settlement_filters", "clean_trades"):
        wide.clear()
        assert REGISTRY[name].run(spark, str(tmp_path)).count() > 0
        assert len(wide) <= 2, (name, wide)


def test_bonds_outstanding_edges(spark):
    day = dt.date
    spans = [(day(2014, 1, 1), day(2014, 4, 1)), (day(2014, 1, 2), day(2014, 3, 31)), (day(2010, 1, 1), day(2030, 1, 1)), (day(2016, 10, 2), day(2020, 1, 1)),
             (day(2010, 1, 1), day(2013, 12, 31)), (day(2015, 6, 30), day(2015, 7, 1))]
    got = {r["date"]: r["n"] for r in bonds_outstanding(spark.createDataFrame(spans, "offering_date date, maturity date")).collect()}
    grid = [day(2014 + q // 4, q % 4 * 3 + 1, 1) for q in range(12)]
    assert got == {q: n for q in grid if (n := sum(a <= q <= b for a, b in spans))}
