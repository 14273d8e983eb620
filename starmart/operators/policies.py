"""Row policies by role, applied as filters that reach the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    role: str
    table: str
    predicate: str
    action: str = "select"


@dataclass(frozen=True)
class AccessRules:
    """Grants say which tables a role may touch, policies which rows it sees there."""

    policies: Sequence[Policy]
    grants: Sequence[tuple[str, str, str]]  # role, table, action
    protected: Sequence[str]

    def allowed(self, role: str, table: str, action: str) -> bool:
        return (role, table, action) in set(self.grants)

    def predicate(self, role: str, table: str, action: str) -> Column:
        """OR of the role's policies; a protected table without one shows nothing."""
        if table not in self.protected:
            return F.lit(True)
        mine = [
            F.coalesce(F.expr(p.predicate), F.lit(False))
            for p in self.policies
            if (p.role, p.table, p.action) == (role, table, action)
        ]
        return reduce(lambda a, b: a | b, mine) if mine else F.lit(False)


def as_role(df: DataFrame, table: str, role: str, rules: AccessRules) -> DataFrame:
    """What ``role`` sees of ``table``."""
    if not rules.allowed(role, table, "select"):
        raise PermissionError(f"permission denied for table {table}")
    return df.filter(rules.predicate(role, table, "select"))


def may_change(table: str, role: str, rules: AccessRules) -> Column:
    """Which rows of ``table`` the role may see and change."""
    if not rules.allowed(role, table, "update"):
        raise PermissionError(f"permission denied for table {table}")
    return rules.predicate(role, table, "update") & rules.predicate(role, table, "select")


def update_as_role(df: DataFrame, table: str, role: str, changes: Mapping[str, Column], rules: AccessRules) -> DataFrame:
    """The table after an update that touches only rows the role may see and change.

    Returned whole; ``Warehouse.update_as_role`` writes it back.
    """
    mine = may_change(table, role, rules)
    return df.select(
        *[F.when(mine, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in df.columns]
    )


WAREHOUSE_ACCESS = AccessRules(
    policies=[
        Policy("francais", "fait_accident", "id_pays = 1"),
        Policy("anglais", "fait_accident", "id_pays = 2"),
        Policy("medecin", "dim_usager", "gravite IN ('Killed', 'Seriously injured')"),
        Policy("medecin", "dim_usager", "gravite IN ('Killed', 'Seriously injured')", "update"),
        Policy("policier", "dim_vehicule", "true"),
        Policy("admin_global", "fait_accident", "true"),
        Policy("admin_global", "dim_usager", "true"),
        Policy("admin_global", "dim_vehicule", "true"),
    ],
    grants=[
        ("francais", "fait_accident", "select"),
        ("anglais", "fait_accident", "select"),
        ("medecin", "dim_usager", "select"),
        ("policier", "dim_vehicule", "select"),
        *[
            ("admin_global", table, "select")
            for table in [
                "dim_pays", "dim_temps", "dim_meteo", "dim_localisation",
                "dim_usager", "dim_vehicule", "fait_accident",
            ]
        ],
    ],
    protected=["fait_accident", "dim_usager", "dim_vehicule"],
)
