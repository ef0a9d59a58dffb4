"""Where the layers live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LayerConfig:
    """Layer roots and database names.

    ``root`` and ``checkpoint_root`` must be on storage every executor can reach. Checkpoints are
    kept apart from the feeds, so emptying a feed folder never takes the progress with it.
    """

    root: str
    checkpoint_root: str | None = None
    prefix: str = ""

    def layer_path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    @property
    def databases(self) -> dict[str, str]:
        """Database name -> folder, for the three layers."""
        return {
            self.database(layer): f"{self.layer_path(layer)}/tables"
            for layer in ("bronze", "silver", "gold")
        }

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.checkpoint_root or self.root + '/checkpoints'}/{layer}/{name}"
