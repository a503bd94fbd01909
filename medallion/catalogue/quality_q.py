"""Quality-gate and declarative-test queries: Q1-Q11, T1-T4, J3, U3, A3-A8."""

from __future__ import annotations

from ..plans import quality as q
from ..plans.silver import conform
from ..schemas import SILVER_MATCHES, SILVER_TEAMS
from ..sources import fixtures as fx
from . import register
from .gold_q import MTP, PLAYERS_SQL, players_silver

# Staging views over the fixtures, as SQL for the oracle.
STAGING_SQL = f"""{MTP}, {PLAYERS_SQL},
stg_matches as (select * from matches),
stg_teams as (select *, cast(null as varchar) as team_tla from teams),
stg_players as (select * from ranked)"""


STAGING = {
    "stg_matches": lambda spark, sf: conform(fx.matches(spark, sf), SILVER_MATCHES, cast=False),
    "stg_teams": lambda spark, sf: conform(fx.teams(spark, sf), SILVER_TEAMS, cast=False),
    "stg_players": lambda spark, sf, ranked=True: players_silver(spark, sf, "row_number" if ranked else None),
}


def staging(spark, sf, *names, ranked=True):
    """The named staging models (all when none are named); each is built
    only when asked for, and the players' global rank only when ``ranked``."""
    return {n: STAGING[n](spark, sf, *([ranked] if n == "stg_players" else [])) for n in (names or STAGING)}


def _check_sql(view: str, label: str, checks) -> str:
    """Counting SQL for the checks, one SELECT per check, UNION ALL."""
    def s(x):
        return f"coalesce(cast({x} as varchar), 'null')"
    parts = []
    for ch in checks:
        c = ch.column
        if ch.kind == "none_rejected":      # the staging views carry no reject counts
            continue
        if ch.kind == "row_count_min":
            p, v = f"count(*) >= {ch.param}", s("count(*)")
        elif ch.kind == "not_null":
            x = f"count_if({c} is null)"
            p, v = f"{x} = 0", s(x)
        elif ch.kind == "unique":
            d = f"(count(distinct {c}) + coalesce(max(case when {c} is null then 1 else 0 end), 0))"
            p, v = f"{d} = count(*)", f"{s(d)} || '/' || {s('count(*)')}"
        elif ch.kind == "accepted":
            vals = ", ".join(f"'{x}'" for x in ch.param)
            x = f"count_if({c} is not null and {c} not in ({vals}))"
            p, v = f"{x} = 0", s(x)
        elif ch.kind == "required_when":
            miss = " or ".join(f"{x} is null" for x in ch.columns)
            x = f"count_if(coalesce({ch.when}, false) and ({miss}))"
            p, v = f"{x} = 0", s(x)
        elif ch.kind == "length_eq":
            x = f"count_if({c} is not null and length({c}) <> {ch.param})"
            p, v = f"{x} = 0", s(x)
        elif ch.kind == "non_negative":
            x = f"count_if({c} is not null and {c} < 0)"
            p, v = f"{x} = 0", s(x)
        elif ch.kind == "min_eq":
            p, v = f"coalesce(min({c}) = {ch.param}, false)", s(f"min({c})")
        elif ch.kind == "date_range":
            p, v = "true", f"{s(f'min({c})')} || '..' || {s(f'max({c})')}"
        else:
            raise ValueError(ch.kind)
        parts.append(f"select '{label}' as \"table\", '{ch.name}' as \"check\", "
                     f"'{ch.severity}' as severity, coalesce({p}, false) as passed, {v} as value "
                     f"from {view}")
    return "\nunion all\n".join(parts)


@register("dq_matches", f"with {STAGING_SQL}\n{_check_sql('stg_matches', 'matches', q.MATCH_CHECKS)}")
def q_dq_matches(spark, sf):
    return q.check_results(staging(spark, sf, "stg_matches")["stg_matches"], "matches",
                           q.MATCH_CHECKS)


@register("dq_teams", f"with {STAGING_SQL}\n{_check_sql('stg_teams', 'teams', q.TEAM_CHECKS)}")
def q_dq_teams(spark, sf):
    return q.check_results(staging(spark, sf, "stg_teams")["stg_teams"], "teams", q.TEAM_CHECKS)


@register("dq_players", f"with {STAGING_SQL}\n{_check_sql('stg_players', 'players', q.PLAYER_CHECKS)}")
def q_dq_players(spark, sf):
    return q.check_results(staging(spark, sf, "stg_players")["stg_players"], "players",
                           q.PLAYER_CHECKS)


def _test_sql(kind: str) -> str:
    parts = []
    for t in q.STAGING_TESTS:
        if t.test != kind:
            continue
        head = f"select '{t.model}' as model, '{t.test}' as test, '{t.column}' as \"column\", "
        if kind == "not_null":
            body = f"cast(count_if({t.column} is null) as bigint) as failures from {t.model}"
        elif kind == "unique":
            body = (f"cast(count(*) as bigint) as failures from (select {t.column} from {t.model} "
                    f"where {t.column} is not null group by {t.column} having count(*) > 1)")
        elif kind == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in t.values)
            body = (f"cast(count(distinct {t.column}) as bigint) as failures from {t.model} "
                    f"where {t.column} is not null and {t.column} not in ({vals})")
        else:
            body = (f"cast(count(*) as bigint) as failures from {t.model} c "
                    f"where c.{t.column} is not null and not exists "
                    f"(select 1 from {t.to} p where p.{t.parent_key} = c.{t.column})")
        parts.append(head + body)
    return "\nunion all\n".join(parts)


def _tests(kind):
    def run(spark, sf):
        spec = [t for t in q.STAGING_TESTS if t.test == kind]
        names = sorted({t.model for t in spec} | {t.to for t in spec if t.to})
        ranked = any(t.column == "scorer_rank" for t in spec)
        return q.run_tests(staging(spark, sf, *names, ranked=ranked), spec)
    run.__name__ = f"q_test_{kind}"
    return run


for _kind, _name in (("not_null", "test_not_null"), ("unique", "test_unique"),
                     ("accepted_values", "test_accepted_values"),
                     ("relationships", "test_relationships")):
    register(_name, f"with {STAGING_SQL}\n{_test_sql(_kind)}")(_tests(_kind))


# The order priorities treated as known by the unknown-values
# report (the fifth, '5-LOW', is reported).
KNOWN_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")


@register("unknown_values", """
select o_orderpriority as value, count(*) as n_rows
from orders
where o_orderpriority in (
  select o_orderpriority from orders where o_orderpriority is not null
  except
  select * from (values ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED')))
group by o_orderpriority""")
def q_unknown_values(spark, sf):
    from ..sources.tables import read_table
    return q.unknown_values(read_table(spark, sf, "orders"), "o_orderpriority", KNOWN_PRIORITIES)


@register("date_range", f"""
with {fx.fixture_ctes('matches')}
select min(match_date) as earliest, max(match_date) as latest
from matches where match_date is not null""")
def q_date_range(spark, sf):
    return q.date_range(fx.matches(spark, sf), "match_date")
