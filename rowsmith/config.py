"""Job parameters (replaces the reference's YAML files; M6, P7, T1, T2).

Plain dataclasses resolved on the driver. Only job settings live here; data
never does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Reference defaults.
DEFAULT_SAVE_EVERY = 100  # rows between saves when neither call nor config says
DEFAULT_LOG_EVERY = 500  # rows between progress messages
DEFAULT_INPUT_COL = "Fakturabeskrivelse"


def resolve_column(name: str | None, default: str = DEFAULT_INPUT_COL) -> str:
    """A missing column name, or the text ``null`` in any case, means the default."""
    if name is None or str(name).strip().lower() == "null":
        return default
    return name


def resolve_every(explicit: int | None, configured: int | None, default: int = DEFAULT_SAVE_EVERY) -> int:
    """Explicit argument, else config, else default; 0 or None counts as "not set"."""
    for v in (explicit, configured):
        if v:
            return int(v)
    return default


@dataclass(frozen=True)
class ModelParams:
    """M6: fixed settings a backend receives per job (closure, not per row)."""

    model: str = ""
    max_tokens: int = 200
    temperature: float = 0.3


@dataclass(frozen=True)
class JobConfig:
    """What a reference job's YAML holds, as typed fields."""

    input_path: str
    output_path: str
    # Saves of the run, in the shared folder; a folder for each job (``work_folder``).
    work_path: str = ""
    delete_work: bool = False
    input_col: str | None = None
    labels: tuple[str, ...] = ()
    save_every: int | None = None
    log_every: int | None = None
    model: ModelParams = field(default_factory=ModelParams)
    # Context job roles (creditor, invoice number, line number, quantity, unit price).
    creditor_col: str = "Kreditor"
    invoice_col: str = "Fakturanummer"
    line_col: str = "Linjenummer"
    quantity_col: str = "Antal"
    unit_price_col: str = "Stykpris"
    document_id_col: str = "Fakt_ID"
    key_col: str = "id"

    @property
    def work_folder(self) -> str:
        """``work_path``, which a run needs: without one two jobs would take each other's saves for their own."""
        if not self.work_path.strip():
            raise ValueError("set work_path to a folder of this job's own; its saves are kept there")
        return self.work_path

    @property
    def text_col(self) -> str:
        return resolve_column(self.input_col)

    def rows_between_saves(self, explicit: int | None = None) -> int:
        return resolve_every(explicit, self.save_every, DEFAULT_SAVE_EVERY)

    def rows_between_progress(self, explicit: int | None = None) -> int:
        return resolve_every(explicit, self.log_every, DEFAULT_LOG_EVERY)
