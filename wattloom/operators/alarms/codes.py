"""Alarm codes of the rule table: ``TAG[_TYPE[_ID]][:bound or :low-high]``, separated by ``;``.

Codes are read into rows that carry their own ``problem``; rules that concern several rows add theirs with windows over the small table.
:func:`settle` is the barrier between rules and readings: it reads the finished table once, fails with every problem in it, and gives
back plain rows. It runs when a detector is put together, so what the readings hold, or whether there are any, cannot hide a problem.
"""

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.model import SITE, VARIABLE
from wattloom.operators.alarms import text
from wattloom.session import cut_lineage

Defaults = Mapping[str, float | tuple[float, float] | None]
PROBLEM = "problem"
#: Rules that are kept as a table of constants, whose size Spark knows; more are checkpointed.
LOCAL_RULES = 20_000
#: Problems that are listed one by one; the rest are counted.
LISTED = 200


class RuleError(ValueError):
    """All problems of a rule table."""


class Roles(NamedTuple):
    """SQL for a code's role, its element, and what is wrong with it or NULL, from `variable` and `code`."""

    role: str
    element: str
    problem: str


_UNIT, _SECOND = "split(variable, '_')[0]", "try_element_at(split(variable, '_'), 2)"
_IS_TOTAL = f"({_UNIT} = 'PowerIn' AND coalesce({_SECOND}, '') = 'Total')"
_NO_UNIT = "size(split(variable, '_')) <= 1"
_ODD_CODE = "CASE WHEN size(split(code, '_')) NOT IN (2, 3) THEN 'a code here is TAG_TYPE or TAG_TYPE_ID, not ' || code END"
_TYPE = "try_element_at(split(code, '_'), 2)"
_ID_FROM_CODE = "coalesce(try_element_at(split(code, '_'), 3), 'No ID')"
_STRIPPED = f"regexp_replace(regexp_replace(variable, '^[^_]*_?', ''), '{text.ELEMENT_SUFFIXES}', '')"
_PREFIX = f"CASE WHEN {_IS_TOTAL} THEN 'PowerIn_Total' ELSE {_UNIT} END"
_NO_PREFIX = f"CASE WHEN {_NO_UNIT} AND variable <> 'SystemCOP' THEN 'Improper variable name for ' || variable END"

ROLES = {
    # the name's prefix; PowerIn_Total is a role of its own
    "prefix": Roles(_PREFIX, "'No ID'", _NO_PREFIX),
    "element": Roles(_PREFIX, f"CASE WHEN {_IS_TOTAL} THEN 'No ID' ELSE {_STRIPPED} END", _NO_PREFIX),
    # power only: heat pumps are one group, all other power the other
    "ratio": Roles(
        f"CASE WHEN {_IS_TOTAL} THEN 'PowerIn_Total' ELSE 'PowerIn' END",
        f"CASE WHEN variable LIKE '%\\_HPWH%' AND NOT {_IS_TOTAL} THEN 'HPWH' ELSE 'Total' END",
        f"CASE WHEN {_NO_UNIT} OR {_UNIT} <> 'PowerIn' THEN variable || ' is not a power variable' END"),
    # TAG_TYPE or TAG_TYPE_ID
    "code": Roles(_TYPE, _ID_FROM_CODE, _ODD_CODE),
    # a power variable by name, a temperature's ON/OFF and mode by code
    "change": Roles(
        f"CASE {_UNIT} WHEN 'PowerIn' THEN 'PowerIn' WHEN 'Temp' THEN {_TYPE} END",
        f"CASE {_UNIT} WHEN 'Temp' THEN {_ID_FROM_CODE} ELSE 'No ID' END",
        f"CASE {_UNIT} WHEN 'PowerIn' THEN NULL WHEN 'Temp' THEN {_ODD_CODE} "
        f"ELSE variable || ' is neither a power nor a temperature' END"),
}


class Spec(NamedTuple):
    """How the codes of one tag are read."""

    tag: str
    defaults: Defaults
    ranged: bool = False
    roles: str = "prefix"


def _default(defaults: Defaults, place: int) -> str:
    found = {role: v[place] if isinstance(v, tuple) else v for role, v in defaults.items()}
    arms = " ".join(f"WHEN '{role}' THEN double({v})" for role, v in found.items() if v is not None)
    return f"CASE role {arms} END" if arms else "double(NULL)"


def read(rules: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """One row per code of the tags: ``[site,] variable, pretty, tag, role, element, bound, bound2, problem``, in one pass.

    A code without a bound takes the default of its role; a bound that is no number is NULL. A variable without a name has no codes.
    Several aliases of a variable repeat its codes; they count once.
    """
    for needed in ("variable_name", "alarm_codes"):
        if needed not in rules.columns:
            raise ValueError(f"the rule table has no column {needed}")
    for s in specs:
        if s.roles not in ROLES:
            raise ValueError(f"unknown role source {s.roles!r}")
    keys = [SITE] if SITE in rules.columns else []
    pretty = "coalesce(pretty_name, variable_name)" if "pretty_name" in rules.columns else "variable_name"
    tags = ", ".join(f"'{s.tag}'" for s in specs)

    def by_tag(pick) -> str:
        return "CASE tag " + " ".join(f"WHEN '{s.tag}' THEN {pick(s)}" for s in specs) + " END"

    each = "transform(split(alarm_codes, ';'), c -> trim(c))"
    tagged = f"transform({each}, c -> struct(c AS full, get(filter(array({tags}), t -> startswith(c, t)), 0) AS tag))"
    coded = rules.where("variable_name IS NOT NULL").selectExpr(
        *keys, "variable_name AS variable", f"{pretty} AS pretty", f"inline(filter({tagged}, x -> x.tag IS NOT NULL))")
    split_up = coded.selectExpr(
        *keys, "variable", "pretty", "tag", "full", "split(full, ':')[0] AS code", "try_element_at(split(full, ':'), 2) AS _bounds")
    named = split_up.selectExpr(
        *keys, "variable", "pretty", "tag", "full", "_bounds", f"{by_tag(lambda s: ROLES[s.roles].role)} AS role",
        f"{by_tag(lambda s: ROLES[s.roles].element)} AS element", f"{by_tag(lambda s: ROLES[s.roles].problem)} AS _odd")
    ranged = "tag IN (" + ", ".join(f"'{s.tag}'" for s in specs if s.ranged) + ")" if any(s.ranged for s in specs) else "false"
    return named.distinct().selectExpr(
        *keys, "variable", "pretty", "tag", "role", "element",
        f"CASE WHEN _bounds IS NULL THEN {by_tag(lambda s: _default(s.defaults, 0))} "
        f"WHEN {ranged} THEN try_cast(split(_bounds, '-')[0] AS double) ELSE try_cast(_bounds AS double) END AS bound",
        f"CASE WHEN _bounds IS NULL THEN {by_tag(lambda s: _default(s.defaults, 1))} "
        f"WHEN {ranged} THEN try_cast(try_element_at(split(_bounds, '-'), 2) AS double) END AS bound2",
        "coalesce(_odd, CASE WHEN size(split(full, ':')) > 2 THEN 'more than one colon in the code ' || full END, "
        f"CASE WHEN {ranged} AND size(split(_bounds, '-')) <> 2 THEN 'a range is written low-high, not ' || _bounds END) AS {PROBLEM}")


def parse(rules: DataFrame, tag: str, defaults: Defaults, *, ranged: bool = False, roles: str = "prefix") -> DataFrame:
    """The codes of one tag, as :func:`read` gives them."""
    return read(rules, [Spec(tag, defaults, ranged, roles)])


def check(parsed: DataFrame, tags: Sequence[str], by: Sequence[str], wrong, problem: Column) -> DataFrame:
    """Mark rows of ``tags`` whose group ``by`` breaks a rule; ``wrong(count)`` counts conditions within a group. Sites are apart."""
    keys = [SITE] if SITE in parsed.columns else []
    w = Window.partitionBy(*keys, "tag", *by)
    broken = F.col("tag").isin(list(tags)) & wrong(lambda condition: F.count(F.when(condition, 1)).over(w))
    return parsed.withColumn(PROBLEM, F.coalesce(PROBLEM, F.when(broken, problem)))


def one_per_variable(parsed: DataFrame, tags: Sequence[str]) -> DataFrame:
    """A variable has one code of a tag."""
    return check(parsed, tags, [VARIABLE], lambda n: n(F.lit(True)) > 1,
                 F.concat(F.col(VARIABLE), F.lit(" has several codes of "), F.col("tag")))


def settle(rules: DataFrame) -> DataFrame:
    """The rules as plain rows, after all of their problems have been looked at; any problem fails, and all are listed.

    Runs a job over the rule table. Up to ``LOCAL_RULES`` rows become constants, so Spark knows their size; a larger table is
    checkpointed.
    """
    kept = [c for c in rules.columns if c != PROBLEM]
    table = rules.limit(LOCAL_RULES + 1).toArrow()
    small = table.num_rows <= LOCAL_RULES
    whole = None if small else cut_lineage(rules)
    if PROBLEM in rules.columns:
        if small:
            found = sorted({p for p in table.column(PROBLEM).to_pylist() if p is not None})
            count = len(found)
        else:
            problems = whole.where(F.col(PROBLEM).isNotNull()).select(PROBLEM).distinct()
            found, count = [r[0] for r in problems.orderBy(PROBLEM).limit(LISTED).collect()], problems.count()
        if count:
            more = f"; and {count - LISTED} more" if count > LISTED else ""
            raise RuleError("; ".join(found[:LISTED]) + more)
    if whole is not None:
        return whole.select(kept)
    return rules.sparkSession.createDataFrame(table.select(kept), rules.select(kept).schema)


def boundary(rules: DataFrame, default_rows: int = 15) -> DataFrame:
    """Boundary rules come from the columns ``low_alarm``, ``high_alarm`` and ``fault_time``."""
    for needed in ("variable_name", "high_alarm", "low_alarm"):
        if needed not in rules.columns:
            raise ValueError(f"the rule table has no column {needed}")
    keys = [SITE] if SITE in rules.columns else []
    pretty = F.coalesce("pretty_name", "variable_name") if "pretty_name" in rules.columns else F.col("variable_name")
    rows = F.col("fault_time").cast("string").try_cast("double").cast("int") if "fault_time" in rules.columns else F.lit(None).cast("int")
    return rules.where("variable_name IS NOT NULL").select(
        *keys, F.col("variable_name").alias("variable"), pretty.alias("pretty"),
        F.col("low_alarm").cast("string").try_cast("double").alias("low"),
        F.col("high_alarm").cast("string").try_cast("double").alias("high"),
        F.coalesce(rows, F.lit(default_rows)).alias("need")).distinct()


def attach(df: DataFrame, rules: DataFrame, how: str = "inner") -> DataFrame:
    """Join readings with their rules on the variable, and on the site where rules name one."""
    keys = [VARIABLE, SITE] if SITE in rules.columns else [VARIABLE]
    return df.join(rules, keys, how)
