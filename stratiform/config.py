"""Environment naming and job settings shared by every model and job."""

from __future__ import annotations

from dataclasses import dataclass, field

# Namespace prefixes, each suffixed by the environment name.
NAMESPACES = {
    "raw_ext": "raw_ext",
    "curated_ext": "curated_ext",
    "curated": "curated",
    "curated_iceberg": "curated_iceberg",
    "analytics": "analytics",
    "enterprise": "enterprise",
}

# The environments that exist; the first is the default.
ENVIRONMENTS = ("dev", "staging", "prod")

# Raw sources that exist only once their files have landed.
OPTIONAL_SOURCES = ("orders", "sales_transactions")


@dataclass(frozen=True)
class EnvConfig:
    """One environment: how its namespaces are called and which options it runs with.

    ``catalog`` names a DataSource V2 catalog configured on the session. When it
    is ``None`` tables live in the session catalog as Parquet tables. ``sandbox``
    sets a private copy of the environment's namespaces apart from the shared one. With
    ``late_rows`` later runs of the daily fact take in the files that came since, whatever
    their days; without it they look back some days.
    """

    env: str = "dev"
    catalog: str | None = None
    curated_root: str | None = None
    sources: tuple = field(default_factory=tuple)
    enable_sales_orders: bool = False
    sandbox: str = ""
    late_rows: bool = False

    def __post_init__(self) -> None:
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"unknown environment {self.env!r}, expected one of {ENVIRONMENTS}")

    @property
    def require_partition_filter(self) -> bool:
        """Guarded reads must name their partitions in production only."""
        return self.env == "prod"

    def namespace(self, layer: str) -> str:
        if layer not in NAMESPACES:
            raise ValueError(f"unknown layer {layer!r}, expected one of {sorted(NAMESPACES)}")
        return "_".join(p for p in (NAMESPACES[layer], self.env, self.sandbox) if p)

    def table(self, layer: str, name: str) -> str:
        """Catalog name of a table, with the V2 catalog in front when there is one."""
        parts = [self.catalog, self.namespace(layer), name]
        return ".".join(p for p in parts if p)

    def view(self, layer: str, name: str) -> str:
        """Temp view name; temp views have no namespace, so it becomes a prefix."""
        return f"{self.namespace(layer)}_{name}"
