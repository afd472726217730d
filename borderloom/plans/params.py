"""Thresholds of the operators: one set a theme, overridden by a border pair's section of an INI file."""

from __future__ import annotations

from configparser import ConfigParser
from dataclasses import dataclass, fields, replace


# fixed values: the thresholds in metres, degrees and ratios
@dataclass(frozen=True)
class Params:
    pair: str = "be#fr"
    snap_dist: float = 1.0
    fff_ratio: float = 0.5
    cla_surface_width: float = 50.0
    cla_fictitious_ratio: float = 0.1
    cla_fictitious_length: float = 20.0
    cp_merge_dist: float = 5.0
    cp_merge_dist_tractor: float = 12.0
    cp_intersected_cl_dist: float = 5.0
    cp_undershoot_dist: float = 25.0
    cp_2_cl_snap: float = 5.0
    cl_buffer_dist: float = 20.0
    cl_threshold_no_cl: float = 0.1
    cl_ratio_in_buffer: float = 0.6
    cl_cl_closest_max_dist: float = 2.0
    cl_border_max_angle: float = 25.0
    cl_edge_max_angle: float = 25.0
    cl_edge_max_dist: float = 10.0
    ec_landmask_buffer: float = 10.0
    ec_snap_dist: float = 10.0
    ec_snap_2_edge_end_dist: float = 1.0
    ecl_slim_surface_width: float = 10.0
    ecl_artifact_width: float = 2.0
    ecl_surface_max_area: float = 1e8
    ecl_surface_max_points: int = 10_000
    ecl_antenna_ratio: float = 0.0
    ecl_antenna_ratio_buffered: float = 0.70
    ecl_antenna_landmask_buffer: float = 20.0
    ecl_antenna_min_length: float = 20.0
    ecl_antenna_min_length_in_country: float = 75.0
    ecl_parallel_edge_max_dist: float = 0.1
    ecl_antenna_min_dist_2_neighbor: float = 5.0
    ecl_tiny_edge_max_length: float = 0.2
    ecl_sql_filter: str = ""
    dist_max_junctions: float = 10.0


# fixed values: what the themes change
THEMES = {
    "tn": Params(),
    "hy": Params(cp_undershoot_dist=35.0, cl_edge_max_angle=45.0, cl_edge_max_dist=14.0, ec_landmask_buffer=20.0),
    "ra": Params(cp_merge_dist=15.0),
}


def load(theme: str, pair: str = "be#fr", ini_text: str | None = None) -> Params:
    """A theme's thresholds with those of an INI text: its [params] section, then the pair's own."""
    out = replace(THEMES[theme], pair=pair)
    if not ini_text:
        return out
    ini = ConfigParser(delimiters=("=",), comment_prefixes=(";",), inline_comment_prefixes=(";",), interpolation=None)
    ini.read_string(ini_text)
    kinds = {f.name: type(getattr(out, f.name)) for f in fields(out)}
    for section in ("params", pair):
        if ini.has_section(section):
            out = replace(out, **{k: kinds[k](v) for k, v in ini.items(section) if k in kinds and k != "pair"})
    return out
