"""Configuration of one integrated entity: key, sequence, typed columns, rules."""

from __future__ import annotations

from dataclasses import dataclass

DROP, WARN, FAIL = "drop", "warn", "fail"


@dataclass(frozen=True)
class Rule:
    """A data-quality rule.  ``violation`` is a SQL boolean; the rule is broken only
    when it evaluates to TRUE (a NULL comparison does not break a range rule)."""

    name: str
    violation: str
    severity: str = DROP


@dataclass(frozen=True)
class Entity:
    """One entity of the integration layer.

    ``columns`` maps each typed output column to a SQL expression over the staged
    columns; ``hash_columns`` are the staged columns of the row signature;
    drop rules are evaluated on staged columns, warn rules on typed columns.
    ``staged`` gives staged hash columns back by SQL over the typed columns, where the typed column of that
    name has another text; a row for which that is not its staged text keeps its hash.
    """

    name: str
    keys: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    hash_columns: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    sequence: str = "_commit_timestamp"
    tiebreak: tuple[str, ...] = ()
    delete_when: str = "WA_CRUD = 'D'"
    staged: tuple[tuple[str, str], ...] = ()

    @property
    def surrogate(self) -> str:
        return self.name.upper()

    @property
    def wk(self) -> str:
        return f"WK_{self.surrogate}"

    @property
    def wkp(self) -> str:
        return f"WKP_{self.surrogate}"

    @property
    def wkr(self) -> str:
        return f"WKR_{self.surrogate}"

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.column_names if c not in self.keys]

    def rules_of(self, severity: str) -> list[Rule]:
        return [r for r in self.rules if r.severity == severity]
