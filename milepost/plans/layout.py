"""Output layout of the end-to-end job (stage-numbered folders)."""

from __future__ import annotations

from dataclasses import dataclass, field

# The folder names of the original outputs.
FOLDERS = {
    "data": "data",
    "quality": "outputs/01_data_quality",
    "split": "outputs/02_split",
    "eda": "outputs/03_eda",
    "validation": "outputs/04_model_validation",
    "final_metrics": "outputs/05_final_evaluation/metrics",
    "final_predictions": "outputs/05_final_evaluation/predictions",
    "final_reports": "outputs/05_final_evaluation/reports",
    "artifacts": "outputs/05_final_evaluation/artifacts",
}


@dataclass(frozen=True)
class Layout:
    root: str

    def path(self, folder: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{FOLDERS[folder]}/{name}"

    def data(self, name: str) -> str:
        return self.path("data", name)


@dataclass(frozen=True)
class StagedLayout(Layout):
    """Paths in a staging folder (``root``) of the output root ``final``; remembers the
    tables whose paths were asked for."""
    final: str = ""
    asked: list = field(default_factory=list)

    def path(self, folder: str, name: str) -> str:
        self.asked.append(f"{FOLDERS[folder]}/{name}")
        return super().path(folder, name)

    def tables(self) -> list[str]:
        return list(dict.fromkeys(self.asked))
