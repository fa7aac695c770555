"""Constants and the specifications of sources and facts."""

from __future__ import annotations

from dataclasses import dataclass
from enum import IntEnum

# Ids and names that the data carries.


class LoadType(IntEnum):
    VESSEL_REPORT = 1
    IMPORTS = 2
    EXPORTS = 3
    GATE_ACTIVITY = 4
    ON_TERMINAL = 5
    OUT_OF_SERVICE = 6
    STREET_USE_DAYS = 7


class LoadStatus(IntEnum):
    REGISTERED = 1
    INGESTED = 2
    VOYAGES = 3
    DETAILS = 4
    DONE = 5
    ERROR = 99


class VoyageStatus(IntEnum):
    TO_CALL = 1
    CALLED = 2
    CANCELED = 3
    ERROR = 4


#: Id, name, external table, search column, id column, filter, notify flag
FIELD_TYPES = (
    (1, "Equipment Type", "part", "p_type", "p_partkey", None, True),
    (2, "Vessel", None, None, None, None, False),
    (3, "Ocean Carrier", "customer", "c_mktsegment", "c_custkey", "c_acctbal > 0", True),
    (4, "Service", None, None, None, None, False),
    (5, "Location", "nation", "n_name", "n_nationkey", "n_regionkey > 0", True),
    (6, "Origin Port", None, None, None, None, False),
    (7, "Destination Port", None, None, None, None, False),
    (8, "Trucker", "supplier", "s_name", "s_suppkey", "s_acctbal > 0", True),
)
#: Ids of types and codes.
EQUIPMENT, OCEAN_CARRIER, LOCATION, TRUCKER = 1, 3, 5, 8
MODES = {"Vessel": 1, "Rail": 2, "Truck": 3}
DIRECTIONS = {"Import": 1, "Export": 2}
GATE_TYPES = {1: "In Gate", 2: "Out Gate"}
EQUIPMENT_TYPES = {"20CH": 1, "40CH": 2, "45CH": 3}

#: Column, equipment, direction, mode, loaded flag
MEASURES = (
    ("im_full20", "20CH", "Import", "Vessel", 1),
    ("im_full40", "40CH", "Import", "Vessel", 1),
    ("im_full45", "45CH", "Import", "Vessel", 1),
    ("im_mt", None, "Import", "Vessel", 0),
    ("ex_full20", "20CH", "Export", "Vessel", 1),
    ("ex_full40", "40CH", "Export", "Vessel", 1),
    ("ex_mt", None, "Export", "Vessel", 0),
    ("rail_im20", "20CH", "Import", "Rail", 0),
    ("rail_im40", "40CH", "Import", "Rail", 0),
)
#: Column, field type
FIELDS = (("vessel", 2), ("line", 3), ("service", 4), ("terminal", 5), ("from_port", 6), ("to_port", 7))
REPORT_TEXT = ("terminal", "vessel", "voyage", "line", "service", "from_port", "to_port")
CANCELED_AFTER_DAYS = 1


@dataclass(frozen=True)
class FactSpec:
    """A fact: what identifies a row, what a later row replaces, which identity columns are names and of which type."""

    identity: tuple[str, ...]
    payload: tuple[str, ...]
    names: tuple[tuple[str, int], ...] = ()
    dated: str = "date"


#: The columns of the four facts.
GATE = FactSpec(
    ("date", "trucker_name", "equip_code", "equip_length", "length_match_id", "ocean_carrier_name", "gate_type_id", "bare_chassis_flag", "container_loaded_flag", "location_name"),
    ("units", "transactions"),
    (("trucker_name", TRUCKER), ("equip_code", EQUIPMENT), ("ocean_carrier_name", OCEAN_CARRIER), ("location_name", LOCATION)),
)
ON_TERMINAL = FactSpec(("date", "equip_code", "location_name"), ("units",), (("equip_code", EQUIPMENT), ("location_name", LOCATION)))
OUT_OF_SERVICE = FactSpec(("date", "equip_code", "location_name"), ("units",), (("equip_code", EQUIPMENT), ("location_name", LOCATION)))
STREET_USE = FactSpec(
    ("out_gate_date", "out_gate_location", "in_gate_date", "in_gate_location", "equipment_code", "ultimate_user"),
    ("count_of_records",),
    (("out_gate_location", LOCATION), ("in_gate_location", LOCATION), ("equipment_code", EQUIPMENT), ("ultimate_user", OCEAN_CARRIER)),
    "out_gate_date",
)
