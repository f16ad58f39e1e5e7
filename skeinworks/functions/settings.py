"""Settings of a deployment, from the environment or a file of ``NAME=value`` lines; the environment wins."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from pathlib import Path

from skeinworks.functions.dates import id_list

PREFIX = "SKEINWORKS_"


@dataclass(frozen=True)
class Settings:
    """The defaults."""

    output_dir: str = "data"
    warehouse_path: str = "data/warehouse"
    parquet_dir: str = "data/parquet"
    cursor_path: str = "data/.export_cursor.json"
    changes_path: str = "data/.export_changes"
    database_url: str | None = None
    promotion_ids: str = "1,2287"
    matches_since_year: int = 2020
    matches_refresh_days: int = 1
    matches_far_future_days: int = 30
    b_promotion_slugs: str = "wwe,aew"

    def promotion_id_list(self) -> list[str] | None:
        """Ids to keep; none given keeps all."""
        return id_list(self.promotion_ids)

    def b_promotion_slug_list(self) -> list[str]:
        return id_list(self.b_promotion_slugs) or []

    @classmethod
    def load(cls, env: dict[str, str] | None = None, file: str | None = None) -> Settings:
        """Unknown names are ignored; a number that isn't one raises ValueError."""
        told = {}
        if file and Path(file).exists():
            pairs = (line.split("=", 1) for line in Path(file).read_text().splitlines() if "=" in line and not line.lstrip().startswith("#"))
            told = {k.strip(): v.strip().strip("\"'") for k, v in pairs}
        told |= os.environ if env is None else env
        given = {f.name: told[PREFIX + f.name.upper()] for f in fields(cls) if PREFIX + f.name.upper() in told}
        return cls(**{k: int(v) if isinstance(getattr(cls, k), int) else v for k, v in given.items()})
