"""Job settings."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class JobConfig:
    """Names and parameters of one run.

    ``database`` may hold ``${env}``, ``${release}`` and ``${layer}``;
    ``query_map`` maps labels to comma-separated SQL file names.
    """

    env: str = ""
    release: str = ""
    layer: str = ""
    database: str = "${env}"
    environment: str = ""
    load_log_key: str = ""
    query_map: Mapping[str, str] = field(default_factory=dict)
    stage_dir: str | None = None
    # With a run_id of one's own: go on where a run of that id was cut off.
    resume: bool = False
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def fill(self, text: str) -> str:
        """Substitute the three placeholders literally."""
        for name in ("env", "release", "layer"):
            text = text.replace("${" + name + "}", getattr(self, name))
        return text

    @property
    def database_name(self) -> str:
        return self.fill(self.database)

    @property
    def sql_files(self) -> list[str]:
        """File names by position.  With several map entries the last one counts."""
        files: list[str] = []
        for value in self.query_map.values():
            files = value.split(",")
        return files

    def sql_path(self, position: int) -> str:
        return f"{self.environment}/{self.sql_files[position]}"
