"""Column masks, row policies and the broker view, applied by caller context.

Policies bind to a table: ``governed(df, ctx, policies)`` is the single choke
point every reader goes through (reports, views, exports).  With a Python
``AccessContext`` the policy branch is decided on the driver, so the plan that
reaches Catalyst is a plain ``Project`` + ``Filter`` that is pushed through the
level-2 projection and below the level-1 join to the customer scan.

The SQL form (``register_governed_view``) keeps the caller on the driver and makes
each view anew when the caller changes, so SQL text can neither name the ungoverned
rows through it nor change the caller.  Whoever can read the files can read the rows:
untrusted consumers receive ``export_governed`` output instead.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.functions.scoring import BROKER_STATES
from riskpipe.sources.schemas import AMOUNT

# fixed value: the step that masked amounts are rounded down to
MASK_STEP = 10000

BROKER_VIEW_COLUMNS = ["policy_number", "age_category", "insured_occupation", "policy_annual_premium",
                       "claim_amount_filled", "customer_state", "total_risk_score", "risk_level",
                       "risk_factors", "last_updated"]


@dataclass(frozen=True)
class RoleNames:
    """The names that the policies know; other deployments give their own."""
    # fixed values: the default role names and the mark of consumer accounts
    admin: tuple[str, ...] = ("ACCOUNTADMIN",)
    analyst: tuple[str, ...] = ("PIPELINE_ANALYST",)
    consumer_mark: str = "CONSUMER"


@dataclass(frozen=True)
class AccessContext:
    """Who is asking (F9: the current role and account name; either may be None)."""
    role: str | None = None
    account: str | None = None
    roles: RoleNames = RoleNames()

    @property
    def is_admin(self) -> bool:
        return self.role in self.roles.admin

    @property
    def is_broker(self) -> bool:
        # LIKE '%CONSUMER%' is case-sensitive
        return (self.role in self.roles.analyst
                or (self.account is not None and self.roles.consumer_mark in self.account))


ADMIN = AccessContext("ACCOUNTADMIN", "MAIN")
ANALYST = AccessContext("PIPELINE_ANALYST", "MAIN")
CONSUMER = AccessContext("BROKER_READER", "BROKER_CONSUMER_1")
OTHER = AccessContext("PUBLIC", "MAIN")


def floor_mask(value: Column, step: int = MASK_STEP) -> Column:
    """``FLOOR(v / step) * step`` in the column's own decimal type; NULL stays NULL."""
    return (F.floor(value / F.lit(step)) * F.lit(step)).cast(AMOUNT)


def mask_sensitive_data(value: Column, ctx: AccessContext) -> Column:
    """Admin sees the value; analyst, consumer account and everyone else see floor-to-10000."""
    return value if ctx.is_admin else floor_mask(value)


def broker_access(state: Column, ctx: AccessContext) -> Column:
    """Admin all rows; analyst or consumer account only broker states; others no rows."""
    if ctx.is_admin:
        return F.lit(True)
    if ctx.is_broker:
        return state.isin(*BROKER_STATES)        # P10
    return F.lit(False)


@dataclass(frozen=True)
class MaskPolicy:
    name: str
    column: str
    fn: Callable[[Column, AccessContext], Column]


@dataclass(frozen=True)
class RowPolicy:
    name: str
    column: str
    fn: Callable[[Column, AccessContext], Column]


@dataclass(frozen=True)
class PolicySet:
    """Policies attached to one table (G6); ``without`` detaches one."""
    masks: tuple[MaskPolicy, ...] = ()
    rows: tuple[RowPolicy, ...] = ()

    def without(self, name: str) -> "PolicySet":
        return replace(self, masks=tuple(m for m in self.masks if m.name != name),
                       rows=tuple(r for r in self.rows if r.name != name))

    def names(self) -> list[str]:
        return [m.name for m in self.masks] + [r.name for r in self.rows]


RISK_MATRIX_POLICIES = PolicySet(
    masks=(MaskPolicy("mask_sensitive_data", "claim_amount_filled", mask_sensitive_data),),
    rows=(RowPolicy("broker_access", "customer_state", broker_access),),
)


def governed(df: DataFrame, ctx: AccessContext, policies: PolicySet = RISK_MATRIX_POLICIES) -> DataFrame:
    """Apply row policies (filter first, on true values) then column masks.

    G7: apply to the scored level-2 table, never to level 1 — scores and risk
    factors are computed from true amounts; the mask acts on what readers see.
    All other columns pass through unchanged (P2 ``SELECT *``)."""
    out = df
    for rp in policies.rows:
        out = out.where(rp.fn(F.col(rp.column), ctx))
    for mp in policies.masks:
        out = out.withColumn(mp.column, mp.fn(F.col(mp.column), ctx))
    return out


def broker_view(matrix: DataFrame, ctx: AccessContext,
                policies: PolicySet = RISK_MATRIX_POLICIES) -> DataFrame:
    """10 columns of the governed risk matrix, state not NULL."""
    return (governed(matrix, ctx, policies)
            .where(F.col("customer_state").isNotNull())
            .select(*BROKER_VIEW_COLUMNS))


def compare_roles(matrix: DataFrame, contexts: dict[str, AccessContext],
                  report: Callable[[DataFrame], DataFrame],
                  policies: PolicySet = RISK_MATRIX_POLICIES) -> DataFrame:
    """The same report run once per context, labelled and unioned."""
    parts = [report(governed(matrix, ctx, policies)).withColumn("role_name", F.lit(label))
             for label, ctx in contexts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def export_governed(matrix: DataFrame, ctx: AccessContext, path: str,
                    policies: PolicySet = RISK_MATRIX_POLICIES, mode: str = "overwrite") -> None:
    """Materialise the consumer's broker view as parquet; share only that folder."""
    broker_view(matrix, ctx, policies).write.mode(mode).parquet(path)


# ---------------------------------------------------------------------------
# SQL form: views made anew for each caller context


_CONTEXTS: dict[str, AccessContext] = {}
_VIEWS: dict[str, dict[str, Callable[[AccessContext], DataFrame]]] = {}


def _session(spark: SparkSession) -> str:
    return spark._jsparkSession.sessionUUID()


def declare_context_variables(spark: SparkSession, ctx: AccessContext) -> None:
    """Start the SQL surface of a session for ``ctx``, without views yet."""
    _VIEWS[_session(spark)] = {}
    set_context_variables(spark, ctx)


def set_context_variables(spark: SparkSession, ctx: AccessContext) -> None:
    """Switch the session's caller: each governed view is made anew for ``ctx``."""
    _CONTEXTS[_session(spark)] = ctx
    for name, build in _VIEWS.setdefault(_session(spark), {}).items():
        build(ctx).createOrReplaceTempView(name)


def register_governed_view(spark: SparkSession, matrix: DataFrame, name: str = "broker_risk_view", *,
                           columns: list[str] | None = None, require_state: bool = True, roles: RoleNames = RoleNames(),
                           policy: Callable[[DataFrame, AccessContext], DataFrame] = governed) -> None:
    """A temp view of what the session's caller may see, made anew when the caller changes.

    Defaults give the broker view (G9: 10 columns, state not NULL); ``columns=None,
    require_state=False`` gives the governed table itself (every reader of the
    name is governed, G6).  ``policy`` may be one by a table of entitlements.  The view holds
    the governed plan: there is no view of the ungoverned rows that SQL could name, and no SQL statement changes the caller."""
    wanted = BROKER_VIEW_COLUMNS if require_state and columns is None else (columns or matrix.columns)

    def build(ctx: AccessContext) -> DataFrame:
        out = policy(matrix, replace(ctx, roles=roles))
        return (out.where(F.col("customer_state").isNotNull()) if require_state else out).select(*wanted)

    _VIEWS.setdefault(_session(spark), {})[name] = build
    build(_CONTEXTS.get(_session(spark), AccessContext())).createOrReplaceTempView(name)
