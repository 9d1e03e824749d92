"""Parameters of the pipelines: frozen dataclasses, with JSON files laid over the defaults."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields, replace
from pathlib import Path
from typing import TypeVar

# Vehicle class and fuel codes and their labels.
CLASS_LABELS = {"K1": "大型客车", "K2": "中型客车", "K3": "小型客车", "K4": "微型客车", "H1": "重型货车", "H2": "中型货车", "H3": "轻型货车", "H4": "微型货车"}
FUEL_LABELS = {"A": "汽油", "B": "柴油"}
CLASS_CODES = {label: code for code, label in CLASS_LABELS.items()}
FUEL_CODES = {label: code for code, label in FUEL_LABELS.items()}


@dataclass(frozen=True)
class Rules:
    """Which records count as included, and how gaps are binned. The defaults are fixed values."""

    valid_vehicle_types: tuple[str, ...] = ("K1", "K2", "K3", "K4", "H1", "H2", "H3", "H4")
    car_vehicle_types: tuple[str, ...] = ("K1", "K2", "K3", "K4")
    truck_vehicle_types: tuple[str, ...] = ("H1", "H2", "H3", "H4")
    valid_fuel_types: tuple[str, ...] = ("A", "B")
    local_plate_prefixes: tuple[str, ...] = ("粤E", "粤X", "粤Y")
    travel_time_bins: tuple[int, ...] = (0, 60, 300, 900, 1800, 3600, 28800, 43200, 86400)
    travel_time_labels: tuple[str, ...] = ("1m", "5m", "15m", "30m", "1h", "8h", "12h", "24h")
    random_seed: int = 20260224
    sampling_mode: str = "joint"
    timestamp_formats: tuple[str, ...] = ()

    def __post_init__(self):
        if len(self.travel_time_bins) - 1 != len(self.travel_time_labels):
            raise ValueError("travel_time_bins needs one more entry than travel_time_labels")


@dataclass(frozen=True)
class Segmentation:
    """Adaptive thresholds and trips. The defaults are fixed values."""

    fixed_quantile: float = 0.70
    cap_scale: float = 1.5
    std_threshold: float = 100.0
    sample_threshold: int = 50
    n_estimators: int = 15
    random_state: int = 2023
    high_hours: tuple[int, ...] = (7, 8, 17, 18)
    flat_hours: tuple[int, ...] = (9, 10, 11, 12, 13, 14, 15, 16, 19, 20, 21)
    min_trip_seconds: float = 300.0


@dataclass(frozen=True)
class Topology:
    """Road graph and one-to-one matching. The defaults are fixed values."""

    match_distance_m: float = 60.0
    degrees_per_metre_lat: float = 8.993216e-06
    degrees_per_metre_lon: float = 9.769874e-06
    default_speed_kmh: float = 35.73
    motorway_speed_kmh: float = 100.0
    trunk_speed_kmh: float = 80.0
    maxspeed_discount: float = 0.9
    min_speed_kmh: float = 1e-6


# Keys of flat configuration files, and the section and name that each stands for. Keys that are a field's
# own name need no entry.
FLAT = {
    "bayonet_shp_path": ("paths", "checkpoints"), "raw_bayonet_csv_path": ("paths", "raw"), "route_matched_bayonet_csv_path": ("paths", "route"),
    "vehicle_table_2021_path": ("paths", "vehicles"), "preprocessed_data_path": ("paths", "passes"), "vehicle_info_path": ("paths", "vehicle_info"),
    "hourly_stat_path": ("paths", "hourly"), "travel_time_stat_path": ("paths", "gaps"), "excluded_supplement_data_path": ("paths", "excluded_supplement"),
    "excluded_device_attr_path": ("paths", "device_attributes"), "excluded_input_path": ("paths", "excluded_supplement"), "bayonet_match_path": ("paths", "route"),
    "road_shp_path": ("paths", "roads"), "output_dir": ("paths", "output"), "output_prefix": ("paths", "prefix"),
    "raw_csv_encoding": ("", "encoding"), "input_csv_encoding": ("", "encoding"), "output_csv_encoding": ("", "output_encoding"),
    "sampling_dist_force_rebuild": ("", "rebuild"), "bayonet_id_field": ("", "id_field"),
    "fixed_time_quantile": ("segmentation", "fixed_quantile"), "fixed_time_upper_scale": ("segmentation", "cap_scale"), "kkod_std_threshold": ("segmentation", "std_threshold"),
    "kkod_min_samples": ("segmentation", "sample_threshold"), "iforest_n_estimators": ("segmentation", "n_estimators"), "iforest_random_state": ("segmentation", "random_state"),
    "min_trip_duration_sec": ("segmentation", "min_trip_seconds"),
    "match_threshold_m": ("topology", "match_distance_m"), "avg_speed_kmh": ("topology", "default_speed_kmh"),
    "lat_degree_per_meter": ("topology", "degrees_per_metre_lat"), "lon_degree_per_meter": ("topology", "degrees_per_metre_lon"),
}
# Keys about processes, progress and file names, which have no meaning here.
IDLE = (
    "raw_csv_chunksize parallel_workers parallel_submit_window monitor_enabled monitor_show_resources monitor_every_n_chunks sampling_dist_cache_enabled "
    "sampling_dist_parallel_workers sampling_dist_partition_count sampling_dist_keep_temp sampling_dist_fallback_serial_on_error workers shard_count submit_window "
    "progress_step verbose road_graph_filename node_position_filename edges_csv_filename match_npy_filename match_csv_filename"
).split()
SECTIONS = ("paths", "rules", "segmentation", "topology")

C = TypeVar("C", Rules, Segmentation, Topology)


def read_json(path: str) -> dict:
    data = json.loads(Path(path).read_text("utf-8-sig"))
    if not isinstance(data, dict):
        raise ValueError(f"{path}: a JSON object is expected")
    return data


def sections(data: dict) -> dict:
    """The configuration in sections: as it is, or made from a flat file. Keys of a flat file that nothing knows raise."""
    if set(data) & set(SECTIONS) or not data:
        return data
    own = {f.name: name for name, kind in (("rules", Rules), ("segmentation", Segmentation), ("topology", Topology)) for f in fields(kind)}
    out: dict = {name: {} for name in SECTIONS}
    unknown = []
    for key, value in data.items():
        section, name = FLAT.get(key, (own.get(key), key))
        if section is None:
            unknown += [] if key in IDLE or key == "low_hours" else [key]
        elif section:
            out[section][name] = value
        else:
            out[name] = value
    if unknown:
        raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
    if "low_hours" in data:
        g = overlay(Segmentation(), out["segmentation"])
        if sorted(data["low_hours"]) != [h for h in range(24) if h not in (*g.high_hours, *g.flat_hours)]:
            raise ValueError("low_hours must be the hours that are neither high nor flat")
    if "output" not in out["paths"]:
        first = next((out["paths"][k] for k in ("passes", "excluded_supplement", "roads") if k in out["paths"]), None)
        if first:
            out["paths"]["output"] = first.rpartition("/")[0] or "."
    return out


def overlay(base: C, values: dict, strict: bool = True) -> C:
    """base with the values of known names; lists become tuples. Unknown names raise, unless not strict."""
    names = {f.name for f in fields(base)}
    if strict and (unknown := sorted(set(values) - names)):
        raise ValueError(f"unknown parameters: {', '.join(unknown)}")
    return replace(base, **{k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in names})


def load(kind: type[C], path: str | None) -> C:
    return overlay(kind(), read_json(path)) if path else kind()


def dump(config: C, path: str) -> None:
    """Writes all parameters, as a template to edit."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(asdict(config), ensure_ascii=False, indent=2) + "\n", "utf-8")


def align(base: C, shared: dict) -> C:
    """base with whatever another pipeline's configuration says under the same names."""
    return overlay(base, shared, strict=False)
