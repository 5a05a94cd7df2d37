"""Row policy and mask as a table of entitlements.

One row says what a kind of caller may see: ``role`` (its exact name; NULL: any), ``account_part``
(text that the account's name holds; NULL: any), ``state`` (rows of this state; NULL: all rows) and
``mask_step`` (amounts are rounded down to it; NULL: true values).  A caller has every row that fits
both its role and its account; a record is visible if one of these covers its state, under the finest of
their masks.  Roles are added and taken away by publishing another version of the table, without code.

Each version is a folder of its own and counts from the moment its commit file appears; a plan keeps
the version that was newest when it was built.  The caller's entitlements are joined on the state:
broadcast up to ``BROADCAST_STATES`` of them (they are counted first), by a sort-merge join beyond.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.functions.scoring import BROKER_STATES
from riskpipe.operators import governance as G
from riskpipe.streaming import commits

SCHEMA = "role string, account_part string, state string, mask_step long"
BROADCAST_STATES = 100_000
PUSHED_STATES = 1_000       # up to so many are also a filter that reaches the scan


def default_rows(roles: G.RoleNames = G.RoleNames()) -> list[tuple]:
    """The policies of ``governance`` as rows."""
    brokers = [(r, None) for r in roles.analyst] + [(None, roles.consumer_mark)]
    return [(r, None, None, None) for r in roles.admin] + [(r, a, s, G.MASK_STEP) for r, a in brokers for s in BROKER_STATES]


class Entitlements:
    """The versioned table under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._commits = commits.Commits(spark, f"{self.path}/_versions")

    def versions(self) -> list[int]:
        found = (re.fullmatch(r"version=(\d+)", n) for n in commits._names(self.spark, self._commits.path))
        return sorted(int(m[1]) for m in found if m)

    def publish(self, rows: DataFrame) -> int:
        """Make ``rows`` the next version; an error if somebody else published it first."""
        version = max(self.versions(), default=0) + 1
        load = f"load={version}-{uuid.uuid4().hex}"
        rows.selectExpr("CAST(role AS string)", "CAST(account_part AS string)", "CAST(state AS string)", "CAST(mask_step AS long)") \
            .distinct().write.parquet(f"{self.path}/{load}")
        name = f"version={version:09d}"
        self._commits._create(name, f'{{"load": "{load}"}}')
        if self._commits._read(name)["load"] != load:
            raise RuntimeError(f"version {version} of {self.path} was published meanwhile; start again")
        return version

    def grant(self, *rows: tuple) -> int:
        """A version with ``rows`` added."""
        return self.publish(self.read().unionByName(self.spark.createDataFrame(list(rows), SCHEMA)))

    def revoke(self, condition: Column) -> int:
        """A version without the rows for which ``condition`` holds."""
        return self.publish(self.read().where(~F.coalesce(condition, F.lit(False))))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the newest by default); none before the first."""
        there = self.versions()
        if version is not None and version not in there:
            raise ValueError(f"{self.path} has no version {version}")
        if not there:
            return self.spark.createDataFrame([], SCHEMA)
        load = self._commits._read(f"version={version or there[-1]:09d}")["load"]
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{load}")


def granted(entitlements: DataFrame, ctx: G.AccessContext) -> DataFrame:
    """(state, step) of one caller: NULL stands for all states, 0 for true values."""
    role, account = F.lit(ctx.role).cast("string"), F.lit(ctx.account).cast("string")
    mine = ((F.col("role").isNull() | (F.col("role") == role))
            & (F.col("account_part").isNull() | F.contains(account, F.col("account_part"))))
    return entitlements.where(mine).groupBy("state").agg(F.min(F.coalesce("mask_step", F.lit(0))).alias("step"))


def governed(df: DataFrame, ctx: G.AccessContext, entitlements: DataFrame, *, state: str = "customer_state",
             masked: tuple[str, ...] = ("claim_amount_filled",)) -> DataFrame:
    """What ``ctx`` may see of ``df``, by the entitlements' rows.  One small aggregate over these runs at once.

    Records without a state are seen only by callers who see all rows.  Nobody without an entitlement sees a row."""
    mine = granted(entitlements, ctx)
    facts = mine.agg(F.count("state").alias("states"), F.min(F.when(F.col("state").isNull(), F.col("step"))).alias("all")).first()
    side = mine.where("state IS NOT NULL").select(F.col("state").alias("_state"), F.col("step").alias("_step"))
    side = F.broadcast(side) if facts["states"] <= BROADCAST_STATES else side.hint("shuffle_merge")
    if facts["all"] is None:
        if facts["states"] <= PUSHED_STATES:
            df = df.where(F.col(state).isin([r["_state"] for r in side.select("_state").collect()]))
        out, step = df.join(side, F.col(state) == F.col("_state")), F.col("_step")
    elif facts["states"]:
        out, step = df.join(side, F.col(state) == F.col("_state"), "left"), F.least("_step", F.lit(facts["all"]))
    else:
        out, step = df, F.lit(facts["all"])
    rounded = lambda c: (F.floor(F.col(c) / step) * step).cast(df.schema[c].dataType)
    return out.select(*[F.when(step == 0, F.col(c)).otherwise(rounded(c)).alias(c) if c in masked else F.col(f"`{c}`") for c in df.columns])


def bypasses(reader: DataFrame, table: str, entitlements: Entitlements, masked: tuple[str, ...] = ("claim_amount_filled",)) -> list[str]:
    """Ways in which the optimized plan of ``reader`` gets round the entitlements of the stored ``table``; none if it does not.

    A scan of the table has to lie below an inner join with a scan of the entitlements, and a masked column must not be
    among the plan's output as it was stored.  Cached and in-memory relations hide what they read, so each is listed.  Of
    a caller who sees all rows there is no join to find: check the plans of others."""
    plan = reader._jdf.queryExecution().optimizedPlan()
    found: list[str] = []
    table, policy = _plain(table), _plain(entitlements.path)
    shown = {plan.output().apply(i).exprId().toString() for i in range(plan.output().size())}

    def scans(node) -> list[str]:
        leaves = node.collectLeaves()
        return [p for i in range(leaves.size()) for p in _paths(leaves.apply(i))]

    def walk(node, covered: bool) -> None:
        kids = [node.children().apply(i) for i in range(node.children().size())]
        kind = node.getClass().getSimpleName()
        if not kids:
            paths = _paths(node)
            if kind in ("InMemoryRelation", "LogicalRDD"):
                found.append(f"{kind} hides what it reads")
            elif any(_under(p, table) for p in paths):
                if not covered:
                    found.append(f"scan of {table} without the entitlements")
                for i in range(node.output().size()):
                    a = node.output().apply(i)
                    if a.name() in masked and a.exprId().toString() in shown:
                        found.append(f"{a.name()} of {table} without its mask")
        inner = kind == "Join" and node.joinType().toString() == "Inner" and node.condition().isDefined()
        for i, kid in enumerate(kids):
            other = scans(kids[1 - i]) if inner else []
            walk(kid, covered or (bool(other) and all(_under(p, policy) for p in other)))

    walk(plan, False)
    return found


def _plain(path: str) -> str:
    return re.sub(r"^[A-Za-z0-9]+:/+", "/", path).rstrip("/")


def _under(path: str, root: str) -> bool:
    return path == root or path.startswith(root + "/")


def _paths(leaf) -> list[str]:
    if leaf.getClass().getSimpleName() != "LogicalRelation":
        return []
    roots = leaf.relation().location().rootPaths()
    return [_plain(roots.apply(i).toString()) for i in range(roots.size())]
