"""Settings of the steps, with their usual values; a JSON file may override them section by section."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace
from datetime import datetime
from decimal import Decimal
from pathlib import Path
from typing import Any

#: Columns that identify a series.
GROUP = ("publisher_id", "instrument_id", "symbol")
PRICES = ("open", "high", "low", "close")
OHLCV = (*PRICES, "volume")


@dataclass(frozen=True)
class CleanConfig:
    required: tuple[str, ...] = ("ts_event", "rtype", "publisher_id", "instrument_id", "symbol", *OHLCV)
    first_utc: str = "2010-06-06 22:00:00"
    last_utc: str = "2026-07-20 23:59:00"
    root: str = "NQ"
    months: str = "HMUZ"
    future_values: tuple[str, ...] = ("FUTURE", "FUTURES", "FUT")
    option_values: tuple[str, ...] = ("OPTION", "OPTIONS", "OPT")
    tick: Decimal = Decimal("0.25")
    tick_tolerance: Decimal = Decimal("0.000001")
    move_pct: Decimal = Decimal("1.0")
    group: tuple[str, ...] = GROUP
    input_path: str | None = None
    output_path: str | None = None
    large_moves_path: str | None = None
    encoding: str = "utf-8"

    def __post_init__(self):
        if self.tick <= 0 or not 0 <= self.tick_tolerance < 1:
            raise ValueError("tick must be positive, tick_tolerance from 0 to under 1")
        if self.first_utc > self.last_utc:
            raise ValueError("first_utc is after last_utc")


@dataclass(frozen=True)
class PivotConfig:
    left: int = 5
    right: int = 5
    strict_right: bool = True

    def __post_init__(self):
        if self.left < 1 or self.right < 1:
            raise ValueError("left and right must be 1 or more")


def _utc(text: str) -> str:
    moment = datetime.fromisoformat(text)
    if moment.utcoffset() is None:
        raise ValueError(f"{text!r} needs an offset")
    return (moment - moment.utcoffset()).replace(tzinfo=None).isoformat(" ")


#: Settings of a configuration file outside its sections and in each of them, and their names here.
OUTSIDE = {"required_columns": "required", "input_path": "input_path", "output_path": "output_path", "encoding": "encoding"}
SECTIONS = {
    "clean02": {"download_start_utc": "first_utc", "download_end_utc": "last_utc"},
    "clean03": {"future_definition_values": "future_values", "option_definition_values": "option_values"},
    "clean04": {"group_columns": "group"},
    "clean09": {"tick_size": "tick", "tick_tolerance": "tick_tolerance"},
    "clean12": {"return_threshold_pct": "move_pct", "large_up_down_output_path": "large_moves_path"},
}
#: Settings that every section may have and that mean nothing here, and those of one section.
PASSED_OVER = ("default_input_path", "default_output_dir")
PASSED_OVER_IN = {"clean05": ("timestamp_column",), "clean06": ("timestamp_column",)}
ALL_SECTIONS = tuple(f"clean{n:02d}" for n in range(2, 13))


def load_clean_config(path: str | Path) -> CleanConfig:
    """CleanConfig of a JSON object of field names, or of the sections by step (SECTIONS) that its files usually have.

    Times carry an offset; paths are relative to the file's folder. Folders of steps and names of columns
    that are fixed here are passed over (PASSED_OVER); any other name, of a setting or a section, is an error.
    """
    try:
        raw: dict[str, Any] = json.loads(Path(path).read_text(encoding="utf-8"))
    except FileNotFoundError as e:
        raise ValueError(f"no configuration at {path}") from e
    except json.JSONDecodeError as e:
        raise ValueError(f"{path} isn't valid JSON: {e}") from e
    names = {f.name for f in fields(CleanConfig)}
    given = {OUTSIDE.get(k, k): v for k, v in raw.items() if not isinstance(v, dict)}
    if unknown := set(given) - names:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    for section, values in raw.items():
        if not isinstance(values, dict):
            continue
        if section not in ALL_SECTIONS:
            raise ValueError(f"unknown section: {section}")
        if unknown := set(values) - {*SECTIONS.get(section, {}), *PASSED_OVER, *PASSED_OVER_IN.get(section, ())}:
            raise ValueError(f"unknown settings in {section}: {sorted(unknown)}")
    for section, own in SECTIONS.items():
        given |= {name: raw[section][key] for key, name in own.items() if key in raw.get(section, {})}
    read = {c: lambda v: Decimal(str(v)) for c in ("tick", "tick_tolerance", "move_pct")} | {c: _utc for c in ("first_utc", "last_utc")}
    read |= {c: lambda v: str(Path(path).parent / Path(v).expanduser()) for c in ("input_path", "output_path", "large_moves_path")} | {c: lambda v: tuple(x.upper() for x in v) for c in ("future_values", "option_values")}
    made = {k: read[k](v) if k in read else tuple(v) if isinstance(v, list) else v for k, v in given.items()}
    return replace(CleanConfig(), **made)


def derived_path(source: str | Path, step: int, folder: str | Path | None = None) -> Path:
    """Where a step's output stands by default: beside the source, with the step's number in its name."""
    source = Path(source).expanduser()
    return Path(folder or source.parent) / f"{source.stem}_clean{step:02d}{source.suffix}"
