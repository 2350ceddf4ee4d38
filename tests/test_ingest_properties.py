"""Property: the option ingest equals a brute-force model of the landing
rules on random drops - per-file delimiter by majority, header names in
any order and case (rename map, exact, case-insensitive), quoted
delimiters and doubled quotes, trimming of chars <= U+0020, blank -> NULL,
short rows padded, long rows cut, all-empty rows dropped, absent columns
NULL, the half-year period from the file name."""

import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bomspark import schemas as S
from bomspark.sources import ingest as IG
from conftest import write_file

# header spellings per kept column: (name in the file, resolves to it?)
SPELLINGS = {
    "design_configuration": ["design_configuration", "DESIGN_CONFIGURATION"],
    "shop_order_num": ["shop_order_num", "Shop_Order_Num"],
    "Engine_serial": ["engine_serial_num", "Engine_serial", "ENGINE_SERIAL"],
    "option_assembly_num": ["option_assembly_num", "Option_Assembly_Num"],
    "build_year_2": ["build_upfit_date", "build_year_2", "BUILD_YEAR_2"],
}

plain = st.text(alphabet="abXY019 \t-", max_size=6)
quoted = st.text(alphabet="ab1 |,", min_size=0, max_size=5).map(lambda t: f'"{t}"')
doubled = st.tuples(st.text(alphabet="ab1", max_size=3), st.text(alphabet="ab1", max_size=3)) \
    .map(lambda t: f'"{t[0]}""{t[1]}"')
field = st.one_of(plain, plain, quoted, doubled)


@st.composite
def landing_file(draw, idx):
    targets = draw(st.lists(st.sampled_from(list(SPELLINGS)), min_size=1, max_size=5, unique=True))
    names = [draw(st.sampled_from(SPELLINGS[t])) for t in targets]
    if draw(st.booleans()):
        names.insert(draw(st.integers(0, len(names))), "plant_code")
    delim = draw(st.sampled_from(["|", ","]))
    width = len(names)
    rows = []
    for _ in range(draw(st.integers(0, 6))):
        n = max(1, width + draw(st.sampled_from([0, 0, 0, -1, -2, 1])))
        if draw(st.integers(0, 5)) == 0:
            fields = [draw(st.sampled_from(["", " ", "\t"])) for _ in range(n)]
        else:
            fields = [draw(field) for _ in range(n)]
        line = delim.join(fields)
        if line.strip(" \t") == "":
            continue                      # whitespace-only lines: not generated
        rows.append(line)
    month = draw(st.integers(1, 12))
    name = f"BOM_ESN_Option_2020{month:02d}15_{idx}.csv"
    return name, delim.join(names), rows, month


def split_toggle(line, d):
    out, cur, q = [], [], False
    for ch in line:
        if ch == '"':
            q = not q
        elif ch == d and not q:
            out.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
    out.append("".join(cur))
    return out


def java_trim(s):
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 0x20:
        i += 1
    while j > i and ord(s[j - 1]) <= 0x20:
        j -= 1
    return s[i:j]


def model(files):
    out = []
    for name, header, rows, month in files:
        d = "|" if header.count("|") > header.count(",") else ","
        cols = [c.strip() for c in split_toggle(header, d)]
        where = {}
        for target, spellings in SPELLINGS.items():
            for i, c in enumerate(cols):
                if c in (target, *[s for s in spellings if s in S.OPTION_RENAMES
                                   and S.OPTION_RENAMES[s] == target]) or \
                        c.lower() == target.lower():
                    where[target] = i
                    break
        if not where:
            continue
        period = "2020_01" if month <= 6 else "2020_02"
        for line in rows:
            vals = [java_trim(v) or None for v in split_toggle(line, d)]
            vals += [None] * (len(cols) - len(vals))
            rec = tuple(vals[where[t]] if t in where else None for t in S.OPTION_KEEP)
            if any(v is not None for v in rec):
                out.append((name,) + rec + (period,))
    return sorted(out, key=lambda r: tuple("" if v is None else v for v in r))


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.integers(1, 3).flatmap(lambda n: st.tuples(*[landing_file(i) for i in range(n)])))
def test_option_ingest_matches_model(spark, files):
    folder = tempfile.mkdtemp(prefix="bomspark-prop-")
    for name, header, rows, _ in files:
        write_file(folder, name, "\n".join([header] + rows) + "\n")
    got = IG.ingest_bom_option(spark, folder, with_source=True) \
        .select("file_name", *S.OPTION_KEEP, "period").collect()
    got = sorted((tuple(r) for r in got), key=lambda r: tuple("" if v is None else v for v in r))
    assert got == model(files)
    assert os.path.isdir(folder)


# ---------------------------------------------------------------- config and child

CHILD_NAMES = ["rev_option_no", "Option_Number", "OPTION_NO", "child_part", "Child_Part", "qty"]
CONFIG_NAMES = ["engine_serial_num", "ENGINE_SERIAL_NUM", "design_config_num", "Design_Config_Num",
                "build_year", "BUILD_YEAR", "remark"]


@st.composite
def simple_file(draw, names, idx, prefix):
    cols = draw(st.lists(st.sampled_from(names), min_size=1, max_size=5))
    delim = draw(st.sampled_from(["|", ","]))
    rows = []
    for _ in range(draw(st.integers(0, 6))):
        kind = draw(st.integers(0, 6))
        if kind == 0:
            rows.append(draw(st.sampled_from(["", "  ", "\t"])))          # blank line
            continue
        n = max(1, len(cols) + draw(st.sampled_from([0, 0, -1, 1])))
        fields = [draw(st.sampled_from(["", " "])) if kind == 1 else draw(field)
                  for _ in range(n)]
        rows.append(delim.join(fields))
    return f"{prefix}_{idx}.csv", delim.join(cols), rows


def _fields(line, d, width):
    vals = [java_trim(v) or None for v in split_toggle(line, d)]
    return vals + [None] * (width - len(vals))


def child_model(files):
    out = []
    for _, header, rows in files:
        d = "|" if header.count("|") >= header.count(",") else ","
        cols = [c.strip().lower() for c in split_toggle(header, d)]
        opt = max((i for i, c in enumerate(cols) if c in S.CHILD_OPTION_SYNONYMS), default=None)
        child = max((i for i, c in enumerate(cols) if c == S.CHILD_PART_HEADER), default=None)
        if opt is None or child is None:
            continue
        for line in rows:                       # every line is a record, blank too
            v = _fields(line, d, len(cols)) if java_trim(line) else [None] * len(cols)
            out.append((v[opt], v[child]))
    return sorted(out, key=lambda r: tuple("" if x is None else x for x in r))


def config_model(files):
    out = []
    for _, header, rows in files:
        d = "|" if header.count("|") > header.count(",") else ","
        cols = [c.strip().lower() for c in split_toggle(header, d)]
        where = {}
        for i, c in enumerate(cols):
            if c in S.CONFIG_HEADERS:
                where[S.CONFIG_HEADERS[c]] = i               # last one wins
        if len(where) < len(S.CONFIG_HEADERS):
            continue
        for line in rows:
            if not java_trim(line):
                continue                                    # blank lines skipped
            v = _fields(line, d, len(cols))
            out.append(tuple(v[where[c]] for c in (S.ENGINE_SERIAL, S.DESIGN_CONFIG, S.BUILD_YEAR)))
    return sorted(out, key=lambda r: tuple("" if x is None else x for x in r))


def _write(files):
    folder = tempfile.mkdtemp(prefix="bomspark-prop-")
    for name, header, rows in files:
        write_file(folder, name, "\n".join([header] + rows) + "\n")
    return folder


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple("" if x is None else x for x in r))


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.integers(1, 3).flatmap(
    lambda n: st.tuples(*[simple_file(CHILD_NAMES, i, "WC_Option_Child") for i in range(n)])))
def test_child_ingest_matches_model(spark, files):
    got = IG.ingest_option_child(spark, _write(files)).collect()
    assert _sorted(got) == child_model(files)


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.integers(1, 3).flatmap(
    lambda n: st.tuples(*[simple_file(CONFIG_NAMES, i, "BOM_ESN_Config") for i in range(n)])))
def test_config_ingest_matches_model(spark, files):
    got = IG.ingest_bom_config(spark, _write(files)).collect()
    assert _sorted(got) == config_model(files)
