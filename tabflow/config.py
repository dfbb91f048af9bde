"""Typed configuration passed in by the caller (no file or secret loading)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Optional


#: Ends the names of tables of shifted data.
DRIFT_SUFFIX = "_skewed"


@dataclass(frozen=True)
class NumFeature:
    """Numeric feature with optional declared bounds (inclusive)."""

    name: str
    dtype: str = "double"
    min: Optional[float] = None
    max: Optional[float] = None


@dataclass(frozen=True)
class CatFeature:
    """Categorical feature with declared allowed values and optional encoding.

    ``encoding[i]`` is the code of ``allowed_values[i]``.
    """

    name: str
    dtype: str = "string"
    allowed_values: tuple[Any, ...] = ()
    encoding: Optional[tuple[int, ...]] = None

    def __post_init__(self) -> None:
        if self.encoding is not None and len(self.encoding) != len(self.allowed_values):
            raise ValueError(
                f"encoding of '{self.name}' has {len(self.encoding)} entries, "
                f"allowed_values has {len(self.allowed_values)}"
            )


@dataclass(frozen=True)
class ModelParams:
    """Boosted-tree parameters; ranges as declared by the original config."""

    learning_rate: float = 0.1
    n_estimators: int = 20
    max_depth: int = 6
    seed: int = 42

    def __post_init__(self) -> None:
        if not 0 < self.learning_rate <= 1:
            raise ValueError(f"learning_rate must be in (0, 1], got {self.learning_rate}")
        if not 0 < self.n_estimators <= 10000:
            raise ValueError(f"n_estimators must be in (0, 10000], got {self.n_estimators}")
        if not 0 < self.max_depth <= 32:
            raise ValueError(f"max_depth must be in (0, 32], got {self.max_depth}")


@dataclass(frozen=True)
class TableSpec:
    """Describes one use case: table family, key, target and features."""

    catalog: str
    db_schema: str
    use_case: str
    primary_key: str
    target: Optional[str]
    num_features: tuple[NumFeature, ...] = ()
    cat_features: tuple[CatFeature, ...] = ()
    features_to_serve: tuple[str, ...] = field(default_factory=tuple)
    params: ModelParams = field(default_factory=ModelParams)

    @property
    def num_names(self) -> list[str]:
        return [f.name for f in self.num_features]

    @property
    def cat_names(self) -> list[str]:
        return [f.name for f in self.cat_features]

    @property
    def feature_names(self) -> list[str]:
        return self.num_names + self.cat_names

    def table_name(self, role: str = "", drift: bool = False) -> str:
        """Three-part name ``catalog.schema.{use_case}[_{role}][_skewed]``.

        One naming rule for every reader and writer, so a table is always
        looked up under the name it was written with.
        """
        name = self.use_case + (f"_{role}" if role else "") + (DRIFT_SUFFIX if drift else "")
        return f"{self.catalog}.{self.db_schema}.{name}"
