"""Rule tables that normalisation and blocking apply."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ..functions.normalize import CONFUSABLE, LETTER_SHARE


def _skeleton(token: str) -> str:
    letters = sum(c.isalpha() for c in token)
    if token.isdigit() or not token or letters / len(token) < LETTER_SHARE:
        return token
    return token.translate(str.maketrans(CONFUSABLE))


@dataclass(frozen=True)
class RuleSet:
    """Droppable tokens, alternates of tokens, phrases and transliterations. ``mode`` "asis" applies the tables as they
    are spelt to tokens whose look-alikes have collapsed, so spellings with such characters never match; "aligned"
    collapses the tables' too."""

    droppable: frozenset = frozenset()
    expansions: dict = field(default_factory=dict)
    phrases: dict = field(default_factory=dict)
    translit: dict = field(default_factory=dict)
    mode: str = "asis"

    @property
    def drops(self) -> frozenset:
        return frozenset(map(_skeleton, self.droppable)) if self.mode == "aligned" else self.droppable

    @property
    def alternates(self) -> dict:
        if self.mode != "aligned":
            return self.expansions
        out: dict[str, set] = {}
        for k, v in self.expansions.items():
            out.setdefault(_skeleton(k), set()).update(map(_skeleton, v))
        return {k: sorted(v - {k}) for k, v in out.items()}

    @classmethod
    def load(cls, spark: SparkSession, path: str, mode: str = "asis") -> RuleSet:
        """From JSON tables in a folder that any reader of Spark's can open; a missing table is empty."""
        got = {}
        for name in ("droppable", "expansions", "phrases", "translit"):
            try:
                lines = spark.read.text(f"{path}/{name}.json", wholetext=True).collect()  # rule tables are small by nature
            except Exception as e:  # noqa: BLE001
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                lines = []
            got[name] = json.loads(lines[0][0]) if lines else {}
        return cls(frozenset(got["droppable"]), got["expansions"], got["phrases"], got["translit"], mode)

    def save(self, spark: SparkSession, path: str) -> None:
        """Sorted tables, one folder each."""
        tables = {"droppable": sorted(self.droppable), "expansions": {k: sorted(v) for k, v in sorted(self.expansions.items())}, "phrases": dict(sorted(self.phrases.items())), "translit": dict(sorted(self.translit.items()))}
        for name, table in tables.items():
            spark.createDataFrame([(json.dumps(table, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}.json")
