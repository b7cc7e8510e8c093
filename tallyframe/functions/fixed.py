"""Lists, patterns and constants that results depend on."""

# Wire type -> bytes
WIRE_SIZES = {
    "U1": 1, "U2": 2, "U4": 4, "U8": 8,
    "I1": 1, "I2": 2, "I4": 4, "I8": 8,
    "X1": 1, "X2": 2, "X4": 4, "X8": 8,
    "R4": 4, "R8": 8,
    "CH": 1,
}
RANGE_FLOAT_SIZES = {"RU1_3": 1, "RU2_5": 2}

# Frame constants
SYNC = b"\xb5\x62"
FRAME_OVERHEAD = 8
MAX_FRAME = 65543

# Voting
CONFIDENCE_ORDER = ["no_consensus", "single_source", "low", "medium", "high"]
THRESHOLD = 0.75
HIGH_RATIO = 0.9
MIN_SOURCES = 3

# Names of the field that carries a layout version, and look-alikes
VERSION_NAMES = ["version", "msgver", "msg_version", "protocolversion", "ver"]
VERSION_LOOKALIKES = ["swversion", "hwversion", "romversion", "fwversion", "firmware"]
VERSION_VALUE_PATTERNS_HEX = [r"\(0x([0-9a-fA-F]+)[\s\)]", r"0x([0-9a-fA-F]+)"]
VERSION_VALUE_PATTERNS_DEC = [r"(?i)version\s*[=:]\s*(\d+)", r"(?i)version\s+(\d+)\b"]

# Entity names in outline titles
MESSAGE_PREFIX = "UBX-"
MESSAGE_TITLE = r"(UBX-[A-Z0-9]+-[A-Z0-9]+(?:-[A-Z0-9]+)*)"
LOCATED_TITLE = r"(UBX-[A-Z]+-[A-Z0-9]+(?:-[A-Z0-9]+)?)\s*\(?(0x[0-9A-Fa-f]+)?\s*(0x[0-9A-Fa-f]+)?\)?"
GROUP_TITLE = r"(CFG-[A-Z0-9]+)"
KEY_GROUP = r"^(CFG-[A-Z0-9]+)-"
NOT_GROUPS = [
    "CFG-VALDEL", "CFG-VALGET", "CFG-VALSET", "CFG-MSG",
    "CFG-RST", "CFG-PRT", "CFG-CFG", "CFG-OTP",
]

# Source file names: (pattern, family, type, version); "$n" is group n
SOURCE_PATTERNS = [
    (r"u-blox-20-([A-Z]+)-(\d+\.\d+)", "X20", "$1", "$2"),
    (r"u-blox-?(F9|F10|M9|M10|X20)-([A-Z0-9]+(?:-[A-Z0-9]+)?)-(\d+\.\d+)", "$1", "$2", "$3"),
    (r"^(F9|F10|M9|M10)-([A-Z]+)-(\d+\.\d+)", "$1", "$2", "$3"),
]
LEGACY_SOURCE = r"(F9-)?([A-Z]+)120"
LEGACY_F9_TYPES = ["HPS", "LAP"]
KEY_SOURCE_PATTERNS_SHORT = [
    (r"^u-blox-([A-Z0-9]+-[A-Z]+)-([L0-9.]+)_", "$1", "$2", None),
    (r"^u-blox-([A-Z0-9-]+)-(\d+\.\d+)", "$1", "$2", None),
]
KEY_SOURCE_PATTERNS_FULL = [
    (r"^u-blox-([A-Z0-9]+-[A-Z]+)-([L0-9.]+)_", "$1", "$2", "$1-$2"),
    (r"^([A-Z0-9]+-[A-Z]+)-(\d+\.\d+)_", "$1", "$2", "$1-$2"),
    (r"^u-blox_ZED-([A-Z0-9]+)_", "ZED-$1", "unknown", "$1"),
    (r"^u-blox-([A-Z0-9-]+)-(\d+\.\d+)", "$1", "$2", "$1-$2"),
]
# Family from a manual name: first group of substrings found wins
MANUAL_FAMILIES = [
    (["M8", "u-blox8"], "M8"), (["F9"], "F9"), (["F10"], "F10"),
    (["M9"], "M9"), (["M10"], "M10"), (["X20", "F20"], "F10"),
]
SOURCE_PREFERENCE = ["F9", "F10", "X20", "M10", "M9", "M8"]
# (all substrings must occur, in lower case) -> rank
BITFIELD_SOURCE_PREFERENCE = [["f9-hpg", "1.51"], ["f9-hpg"], ["f9"], ["m10"]]
FIRMWARE_TYPES = "HPG|SPG|HPS|LAP|DBD|ADR|MDR|HDG|TIM|UDR|FTS"
# Version tables on front pages, by method, in the order in which they are tried
FRONT_MATTER = [
    ("ext_core_table", rf"(?i)((?:{FIRMWARE_TYPES})(?:\s+L1L5)?\s+\d+\.\d+)\s+(EXT\s+CORE\s+\d+\.\d+\s*\([^)]+\))\s+(\d+\.\d+)"),
    ("rom_prefix_table", rf"(?i)((?:{FIRMWARE_TYPES})\s+\d+\.\d+)\s+((?:ROM|EXT)\s+(?:{FIRMWARE_TYPES}|SPGL1L5|HPGL1L5)\s*\d+\.\d+\s*\([^)]+\))\s+(\d+\.\d+)"),
    ("simple_table", rf"(?i)((?:{FIRMWARE_TYPES})\s+\d+\.\d+(?:B\d+)?)\s+((?:{FIRMWARE_TYPES})\s+\d+\.\d+(?:B\d+)?\s*\([^)]+\))\s+(\d+\.\d+)"),
]

# Repairs of misread text
NAME_REPAIRS = [
    ("CFG-12C", "CFG-I2C"), ("CFG-12CINPROT", "CFG-I2CINPROT"),
    ("CFG-12COUTPROT", "CFG-I2COUTPROT"), ("CFG-0DO", "CFG-ODO"), ("_ENNA", "_ENA"),
]
NAME_REPAIRS_LIGHT = [("CFG-12C", "CFG-I2C"), ("CFG-0DO", "CFG-ODO"), ("_ENNA", "_ENA"), ("_ENAA", "_ENA")]
TYPE_REPAIRS = {"14": "I4", "11": "I1", "12": "I2", "18": "I8"}
UNITS_IN_SCALE = ["m", "s", "Hz", "deg", "ms", "us", "km", "cm", "arcsec", "ppm", "dBHz", "g", "%", "m/s"]
SCALE_BLANKS = ["1", "-", "None"]
UNIT_BLANKS = ["-", "1", "None"]
UNIT_BLANKS_COMPLIANT = ["-", "", " ", "None", "1"]
LIGHT_BLANKS = ["", "-", "1"]
MAX_UNIT_LENGTH = 15
# Greek and Cyrillic letters, and the ASCII letter each is read as
LOOKALIKES = (
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "АВЕКМНОРСТУХЗ",
    "ABEZHIKMNOPTYX" "ABEKMHOPCTYX3",
)

# Enumeration names: removals, then substitutions, applied without regard to case
ENUM_REMOVALS = [r"\([^)]*\)", r"not supported.*", r"extra values.*", r"for protocol.*", r"as defined by.*"]
ENUM_SUBSTITUTIONS = [
    (r"dead reckoning", "dr"), (r"combined", ""), (r"acceleration", ""),
    (r"airborne with", "airborne"), (r"wrist[- ]worn watch", "wrist"),
    (r"user[- ]defined", "user"), (r"is not overridden", "default"),
    (r"set main talker id to", ""), (r"use gnss[- ]specific talker id", "gnss_specific"),
    (r"use the main talker id", "use_main"), (r"satellites are not output", "no_output"),
    (r"use proprietary numbering", "proprietary"), (r"nmea version", "v"),
    (r"enable pio.*output", "pio_enabled"), (r"low means inside", "inside"),
    (r"low means outside.*", "outside"),
]
# then, with regard to case, these, and after lower-casing the last ones
ENUM_SIGNS = [(r"^(\d)D[-\s]?", "_$1d_"), (r"<(\d)g", "$1g"), (r"\s*\+\s*", "_")]
ENUM_SPELLING = [(r"[-\s]+", "_"), (r"[^a-z0-9_]", ""), (r"_+", "_"), (r"^_+|_+$", "")]
ENUM_HEX_PAIR = r"0x([0-9a-fA-F]+)\s*=\s*([^,•\n]+?)(?:,|•|\n|$)"
ENUM_DEC_PAIR = r"(?<!x)(?<![0-9a-fA-F])(\d+)\s*=\s*([^,•\n\d][^,•\n]*?)(?:,|•|\n|$)"

# Collection normaliser
ID_SYNONYMS = {
    "class_id": ["class_id", "ubx_class", "classId", "message_class", "message_class_id", "class"],
    "message_id": ["message_id", "ubx_id", "messageId", "msg_id", "id"],
}
WRAPPER = "ubx_message"
# Reasons for leaving a definition out
REJECTED_STRING = "canonical_structure is string"
REJECTED_SHAPE = "canonical_structure not dict"
REJECTED_CLASS = "no class_id"
REJECTED_MESSAGE = "no message_id"
# Wording of conflicts between sources
CONFLICT_NAME = "Key name conflict"
CONFLICT_NAME_SURE = "Key name mismatch - likely OCR/Unicode error"
CONFLICT_TYPE = "Data type mismatch"
CONFLICT_SCALE = "Scale value differs"
CONFLICT_UNIT = "Unit differs"
CONFLICT_OTHER = "Value differs"
CONFLICT_MISREAD = "Likely OCR error (I vs 1)"
CONFLICT_PREFER_VALUE = " - prefer actual value over '-'"
NO_WINNER = "No winning message available"
MESSAGE_TYPES = {
    "output": "output", "input": "input", "command": "command", "set": "set", "get": "get",
    "get/set": "get_set", "get_set": "get_set", "poll": "poll_request",
    "poll_request": "poll_request", "polled": "polled", "periodic": "periodic",
    "periodic/polled": "periodic_polled", "periodic_polled": "periodic_polled",
    "input/output": "input_output", "input_output": "input_output",
}
FIXED_VALUE_PATTERNS = [
    r"\(0x([0-9a-fA-F]+)\s+for\s+this\s+(?:type|version)\)",
    r"\(0x([0-9a-fA-F]+)\)",
    r"\(0x([0-9a-fA-F]+)\s+for\s+\w",
]
DISCRIMINATOR_PATTERNS = (r"0x([0-9a-fA-F]+)", r"\((\d+)\s+for")

# Audit
STRUCTURAL_KEYWORDS = [
    "offset", "type", "length", "missing", "extra", "size", "count", "byte", "payload", "bitfield",
]
GPIO_FIELDS = ["pinBank", "pinDir", "pinVal", "pinSel", "usedMask"]
MISSING_BUCKETS = [
    ("adr_esf", ["ESF-", "HNR-", "PVAT"]),
    ("legacy", ["AID-", "CFG-PM2", "CFG-TMODE2", "CFG-TXSLOT"]),
    ("security", ["SEC-"]),
]
KEY_TYPES = [
    "L", "U1", "U2", "U4", "U8", "I1", "I2", "I4", "I8",
    "E1", "E2", "E4", "E8", "R4", "R8", "X1", "X2", "X4", "X8",
]
KEY_ID = r"^0x[0-9a-fA-F]{8}$"
ITEM_ID = r"^0x[0-9a-fA-F]{4}$"
GROUP_ID = r"^0x[0-9a-fA-F]{2}$"
KEY_NAME = r"^CFG-[A-Z0-9]+-[A-Z0-9_]+$"
SOURCE_ID = r"^[A-Z0-9]+(-[A-Z0-9.]+)+$|^[A-Z0-9]+$"
CONFIG_SECTION = "Configuration interface"
