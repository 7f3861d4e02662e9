"""The settings of a run: a JSON object, overridden by arguments that are neither zero nor empty."""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class MatchConfig:
    # The names under which configuration files and flags give the settings.
    ReadFileName: str = ""
    GeneFileName: str = ""
    GeneIdFileName: str = ""
    ResultsFileName: str = ""
    Windows: tuple[int, ...] = ()
    WindowWidth: int = 0
    BloomSize: int = 0
    NumHash: int = 0
    PMatch: float = 0.0
    MinDinuc: int = 0
    TempDir: str = ""
    MinReadLength: int = 0
    MaxReadLength: int = 0
    MaxMatches: int = 0
    MaxMergeProcs: int = 0
    MMTol: int = 0
    MatchMode: str = ""

    @classmethod
    def from_json(cls, text: str, **overrides) -> MatchConfig:
        """Keys in any case; unknown ones are ignored."""
        names = {f.name.lower(): f.name for f in fields(cls)}
        found = {names[k.lower()]: v for k, v in json.loads(text).items() if k.lower() in names and v is not None}
        return cls(**{k: tuple(v) if k == "Windows" else v for k, v in found.items()}).overridden(**overrides)

    @classmethod
    def load(cls, path: str, **overrides) -> MatchConfig:
        with open(path, encoding="utf-8") as f:
            return cls.from_json(f.read(), **overrides)

    def overridden(self, **values) -> MatchConfig:
        if isinstance(windows := values.get("Windows"), str):
            values["Windows"] = tuple(int(x) for x in windows.split(",") if x.strip())
        return replace(self, **{k: v for k, v in values.items() if v})

    def checked(self) -> MatchConfig:
        """With defaults filled in; a missing required setting is an error."""
        for name in ("ReadFileName", "GeneFileName", "GeneIdFileName", "ResultsFileName", "Windows", "WindowWidth", "BloomSize", "NumHash", "MaxReadLength", "MaxMatches"):
            if not getattr(self, name):
                raise ValueError(f"{name} must be given")
        if self.PMatch <= 0:
            raise ValueError("PMatch must be over 0")
        if not self.ReadFileName.lower().endswith(".fastq"):
            warnings.warn(f"{self.ReadFileName} is read as FASTQ", stacklevel=2)
        return replace(self, MaxMergeProcs=self.MaxMergeProcs or 3, MatchMode=self.MatchMode or "first")

    def to_json(self) -> str:
        return json.dumps({f.name: getattr(self, f.name) for f in fields(self)}, indent=1)
