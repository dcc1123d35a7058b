"""The registered queries in ANSI SQL, for comparison on another engine.

Written from the definitions of the operators, not from their DataFrame plans.
"""

from __future__ import annotations

SALT = "query-catalog-salt"

_STUDY = "'1.2.840.' || l_orderkey"
_SHIPPED = "strftime(l_shipdate, '%Y%m%d')"


def _pick(number: str, values: list, kind: str = "VARCHAR") -> str:
    shown = ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"([{shown}]::{kind}[])[({number}) % {len(values)} + 1]"


_INSTANCE_COLUMNS = {
    "path": "'raw/study-' || l_orderkey || '/' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '.dcm'",
    "PatientID": """CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN '   '
        WHEN l_orderkey % 107 = 0 THEN '  P' || o_custkey || ' '
        WHEN l_orderkey % 109 = 0 THEN lpad(o_custkey::VARCHAR, 65, '7') ELSE 'P' || o_custkey END""",
    "PatientName": "CASE WHEN o_custkey % 17 <> 0 THEN c_name END",
    "PatientBirthDate": """CASE WHEN o_custkey % 6 <> 0 THEN
        strftime(DATE '1930-01-01' + ((o_custkey * 11) % 25000)::INTEGER, '%Y%m%d') END""",
    "PatientSex": _pick("o_custkey", ["M", "F", "O", "X"]),
    "PatientAge": f"""CASE WHEN o_custkey % 211 = 0 THEN 'XXXY' WHEN o_custkey % 223 = 0 THEN NULL
        WHEN o_custkey % 227 = 0 THEN '45Y'
        ELSE lpad(((o_custkey * 7) % 160)::VARCHAR, 3, '0') || {_pick("l_partkey", ["M", "W", "D", "Y"])} END""",
    "PatientAddress": "CASE o_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN o_custkey || ' Main Street' END",
    "InstitutionName": "'Hospital ' || c_nationkey",
    "InstitutionAddress": "CASE WHEN l_partkey % 2 = 0 THEN 'Block ' || c_nationkey END",
    "ReferringPhysicianName": "'Dr^' || (l_suppkey % 50)",
    "PerformingPhysicianName": "CASE WHEN l_suppkey % 3 = 0 THEN 'Perf^' || l_suppkey END",
    "OperatorsName": "CASE WHEN l_suppkey % 4 = 1 THEN 'Op^' || l_suppkey END",
    "StationName": "'ST' || (l_suppkey % 20)",
    "DeviceSerialNumber": "'SN' || l_suppkey",
    "ProtocolName": "CASE WHEN l_partkey % 7 <> 0 THEN 'Protocol ' || (l_partkey % 30) END",
    "OtherPatientIDs": "CASE WHEN o_custkey % 9 = 0 THEN 'ALT' || o_custkey END",
    "StudyInstanceUID": f"""CASE WHEN l_orderkey % 97 = 0 THEN '1.2..' || l_orderkey
        WHEN l_orderkey % 89 = 0 THEN '1.2.x' || l_orderkey WHEN l_orderkey % 83 = 0 THEN NULL ELSE {_STUDY} END""",
    "StudyDate": """CASE WHEN l_orderkey % 53 = 0 THEN '20251332' WHEN l_orderkey % 59 = 0 THEN '2025010'
        WHEN l_orderkey % 61 = 0 THEN NULL WHEN l_orderkey % 509 = 0 THEN '00010105'
        WHEN l_orderkey % 521 = 0 THEN '99991230' ELSE strftime(o_orderdate, '%Y%m%d') END""",
    "StudyTime": _pick(
        "l_orderkey", ["081500", "256199", "101112.123456", None, "12:30", "235959.1234567", "0930"]
    ),
    "StudyDescription": """CASE WHEN l_orderkey % 71 = 0 THEN repeat('x', 65) WHEN l_orderkey % 74 = 0 THEN NULL
        ELSE 'Study ' || (l_orderkey % 100) END""",
    "AccessionNumber": """CASE WHEN l_orderkey % 73 = 0 THEN 'ACC' || lpad(l_orderkey::VARCHAR, 14, '0')
        WHEN l_orderkey % 79 = 0 THEN NULL ELSE 'ACC' || l_orderkey END""",
    "SeriesDate": _SHIPPED,
    "AcquisitionDate": f"CASE WHEN l_partkey % 5 <> 0 THEN {_SHIPPED} END",
    "ContentDate": f"CASE l_partkey % 3 WHEN 0 THEN {_SHIPPED} WHEN 1 THEN '' END",
    "InstanceCreationDate": "CASE WHEN l_partkey % 4 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') END",
    "SeriesTime": "CASE WHEN l_suppkey % 2 = 0 THEN '101500' END",
    "AcquisitionTime": "CASE WHEN l_suppkey % 5 = 0 THEN '101530' END",
    "ContentTime": "CASE l_suppkey % 7 WHEN 0 THEN '' WHEN 1 THEN '101600' END",
    "SeriesInstanceUID": f"""CASE WHEN l_partkey % 113 = 0 THEN {_STUDY} || '.' WHEN l_partkey % 117 = 0 THEN NULL
        ELSE {_STUDY} || '.' || l_suppkey END""",
    "SeriesNumber": """CASE WHEN l_partkey % 127 = 0 THEN '100000' WHEN l_partkey % 131 = 0 THEN 'abc'
        WHEN l_partkey % 137 = 0 THEN l_suppkey || '.0' WHEN l_partkey % 139 = 0 THEN NULL
        WHEN l_partkey % 141 = 0 THEN '7.5' ELSE l_suppkey::VARCHAR END""",
    "SeriesDescription": """CASE WHEN l_partkey % 119 = 0 THEN repeat('y', 70) WHEN l_partkey % 118 = 0 THEN NULL
        ELSE 'Series ' || (l_suppkey % 10) END""",
    "Modality": f"""CASE WHEN l_partkey % 149 = 0 THEN NULL WHEN l_partkey % 151 = 0 THEN 'X'
        ELSE {_pick("l_partkey", ["CT", "MR", "CR", "DX", "XA", "PT", "NM", "US", "ct", "ZZ"])} END""",
    "SOPInstanceUID": f"""CASE WHEN (l_suppkey * 31 + l_partkey) % 191 <> 0 THEN
        {_STUDY} || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey END""",
    "SOPClassUID": """CASE WHEN l_partkey % 157 = 0 THEN '1..2' WHEN l_partkey % 163 = 0 THEN NULL
        ELSE '1.2.840.10008.5.1.4.1.1.' || (l_partkey % 10 + 1) END""",
    "InstanceNumber": """CASE WHEN l_partkey % 167 = 0 THEN '-1' WHEN l_partkey % 169 = 0 THEN NULL
        ELSE l_linenumber::VARCHAR END""",
    '"Rows"': _pick("l_partkey + l_suppkey", [512, 256, 32, 0, None, 65536, 1024, 512, 512, 512, 512], "INTEGER"),
    '"Columns"': _pick("l_partkey + l_suppkey * 3", [512, 256, 32, 0, None, 512, 1024, 512, 512], "INTEGER"),
    "BitsAllocated": _pick("l_partkey", [16, 16, 12, None, 16, 16, 65], "INTEGER"),
    "BitsStored": _pick("l_suppkey", [12, 12, 16, None, 12, 0], "INTEGER"),
    "PixelSpacing": "CASE WHEN l_partkey % 6 < 4 THEN [0.5, 0.5] WHEN l_partkey % 6 = 4 THEN [0.7] END",
    "KVP": """CASE WHEN l_partkey % 110 = 0 THEN NULL WHEN l_partkey % 170 = 0 THEN 'n/a'
        ELSE (l_quantity::INTEGER * 5)::VARCHAR END""",
    "SliceThickness": """CASE WHEN l_partkey % 180 = 0 THEN '-2.5' WHEN l_partkey % 130 = 0 THEN NULL
        ELSE round(l_discount * 100)::INTEGER::VARCHAR END""",
    "ReconstructionDiameter": "CASE WHEN l_partkey % 30 <> 0 THEN (l_quantity::INTEGER * 10)::VARCHAR END",
    "RepetitionTime": """CASE WHEN l_partkey % 121 = 0 THEN NULL WHEN l_partkey % 171 = 0 THEN '-1'
        ELSE (l_quantity::INTEGER * 40)::VARCHAR END""",
    "EchoTime": "CASE WHEN l_partkey % 21 <> 0 THEN (round(l_discount * 100)::INTEGER + 2)::VARCHAR END",
    "MagneticFieldStrength": _pick("l_suppkey", ["1.5", "3", "7", "25", None, "3.0"]),
    "has_pixel_data": "l_suppkey % 7 <> 0",
    "private_count": "CASE l_partkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END",
    "l_returnflag": "l_returnflag",
}
INSTANCES = (
    "inst AS (SELECT "
    + ", ".join(f"{text} AS {name}" for name, text in _INSTANCE_COLUMNS.items())
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"
)


def _over(select: str, *more: str) -> str:
    return "WITH " + ", ".join((INSTANCES, *more)) + " " + select


def _codes(rules: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {broken} THEN '{code}' END" for code, broken in rules.items())
    return f"concat_ws(',', {cases})"


def _verdict(rules: dict[str, str], source: str = "inst", key: str = "path") -> str:
    return f"SELECT {key}, codes AS error_codes, codes = '' AS is_valid FROM (SELECT *, {_codes(rules)} AS codes FROM {source})"


def _uid_text(c: str) -> str:
    return f"({c} IS NULL OR NOT regexp_full_match({c}, '[0-9.]+'))"


def _uid_dots(c: str) -> str:
    return f"coalesce({c} LIKE '.%' OR {c} LIKE '%.' OR {c} LIKE '%..%', false)"


def _real(c: str) -> str:
    return f"try_cast({c} AS DOUBLE)"


def _whole(c: str) -> str:
    return f"(CASE WHEN {_real(c)} = floor({_real(c)}) THEN {_real(c)} END)"


def _outside(c: str, value: str, least: int, most: int | None = None) -> str:
    inside = f"{value} >= {least}" + ("" if most is None else f" AND {value} <= {most}")
    return f"({c} IS NOT NULL AND NOT coalesce({inside}, false))"


_STRIPPED = r"regexp_replace(PatientID, '^\s+|\s+$', '', 'g')"
PATIENT = {
    "P1": "(PatientID IS NULL OR length(PatientID) NOT BETWEEN 1 AND 64)",
    "P2": f"{_STRIPPED} = ''",
    "P3": "PatientSex NOT IN ('M', 'F', 'O')",
    "P4": "NOT regexp_full_match(PatientAge, '[0-9]{3}[DWMY]')",
    "P5": "(regexp_full_match(PatientAge, '[0-9]{3}Y') AND try_cast(PatientAge[1:3] AS INTEGER) > 150)",
}
STUDY = {
    "S1": _uid_text("StudyInstanceUID"),
    "S2": _uid_dots("StudyInstanceUID"),
    "S3": "NOT regexp_full_match(StudyDate, '[0-9]{8}')",
    "S4": "(regexp_full_match(StudyDate, '[0-9]{8}') AND try_strptime(StudyDate, '%Y%m%d') IS NULL)",
    "S5": r"NOT regexp_full_match(StudyTime, '[0-9]{6}(\.[0-9]{1,6})?')",
    "S6": "(coalesce(length(StudyDescription) > 64, false) OR coalesce(length(AccessionNumber) > 16, false))",
}
SERIES = {
    "E1": _uid_text("SeriesInstanceUID"),
    "E2": _uid_dots("SeriesInstanceUID"),
    "E3": _outside("SeriesNumber", _whole("SeriesNumber"), 0, 99999),
    "E4": "length(SeriesDescription) > 64",
    "E5": "(Modality IS NULL OR length(Modality) NOT BETWEEN 2 AND 16)",
}
_HAS_IMAGE = '("Rows" IS NOT NULL OR "Columns" IS NOT NULL)'
IMAGE = {
    code: f"({_HAS_IMAGE} AND {broken})"
    for code, broken in {
        "I1": '"Rows" NOT BETWEEN 1 AND 65535',
        "I2": '"Columns" NOT BETWEEN 1 AND 65535',
        "I3": "BitsAllocated NOT BETWEEN 1 AND 64",
        "I4": "BitsStored NOT BETWEEN 1 AND 64",
        "I5": "len(PixelSpacing) <> 2",
        "I6": "BitsStored > BitsAllocated",
    }.items()
}
_CT = {
    "C1": _outside("KVP", _real("KVP"), 0, 200),
    "C2": _outside("SliceThickness", _real("SliceThickness"), 0),
    "C3": _outside("ReconstructionDiameter", _real("ReconstructionDiameter"), 0),
}
_MR = {
    "M1": _outside("RepetitionTime", _real("RepetitionTime"), 0),
    "M2": _outside("EchoTime", _real("EchoTime"), 0),
    "M3": _outside("MagneticFieldStrength", _real("MagneticFieldStrength"), 0, 20),
}
MODALITY = {c: f"(Modality = 'CT' AND {b})" for c, b in _CT.items()} | {
    c: f"(Modality = 'MR' AND {b})" for c, b in _MR.items()
}
INSTANCE = {
    "N1": f"({_uid_text('SOPInstanceUID')} OR {_uid_dots('SOPInstanceUID')})",
    "N2": f"({_uid_text('SOPClassUID')} OR {_uid_dots('SOPClassUID')})",
    "N3": _outside("InstanceNumber", _whole("InstanceNumber"), 0),
}
RECORD = {**PATIENT, **STUDY, **SERIES, **IMAGE, **MODALITY, **INSTANCE}
SIDE = {**PATIENT, **STUDY, **SERIES, **INSTANCE}

_REMOVE = (
    "PatientName PatientBirthDate PatientAddress InstitutionName InstitutionAddress ReferringPhysicianName"
    " PerformingPhysicianName OperatorsName DeviceSerialNumber ProtocolName StationName OtherPatientIDs"
).split()
_ALL_REMOVED = (
    "PatientName PatientBirthDate PatientAddress PatientTelephoneNumbers PatientMotherBirthName MilitaryRank"
    " BranchOfService MedicalRecordLocator InstitutionName InstitutionAddress InstitutionalDepartmentName"
    " ReferringPhysicianName ReferringPhysicianAddress ReferringPhysicianTelephoneNumbers PerformingPhysicianName"
    " NameOfPhysiciansReadingStudy OperatorsName RequestingPhysician StudyIDIssuer IssuerOfPatientID"
    " DeviceSerialNumber PlateID ProtocolName StationName OtherPatientIDs OtherPatientNames RegionOfResidence"
    " CurrentPatientLocation PatientInstitutionResidence"
).split()
_HASH = ["PatientID", "AccessionNumber"]
_DATES = "StudyDate SeriesDate AcquisitionDate ContentDate InstanceCreationDate".split()
_INVENTORY = (
    "PatientName PatientID PatientBirthDate PatientSex PatientAge PatientAddress InstitutionName InstitutionAddress"
    " ReferringPhysicianName PerformingPhysicianName StudyDate StudyTime SeriesDate SeriesTime AcquisitionDate"
    " AcquisitionTime ContentDate ContentTime"
).split()
_COLUMNS_LEFT = (
    "path PatientID AccessionNumber StudyDate SeriesDate AcquisitionDate ContentDate InstanceCreationDate StudyTime"
    " SeriesTime AcquisitionTime ContentTime InstanceCreationTime PatientSex PatientAge StudyInstanceUID"
    " StudyDescription SeriesInstanceUID SeriesNumber SeriesDescription Modality SOPInstanceUID SOPClassUID"
    " InstanceNumber KVP SliceThickness ReconstructionDiameter RepetitionTime EchoTime MagneticFieldStrength"
    " PatientIdentityRemoved DeidentificationMethod Rows Columns BitsAllocated BitsStored PixelSpacing"
    " has_pixel_data tags private_tags"
).replace(" ", ",")


def _hash(c: str) -> str:
    return f"sha256({c} || '{SALT}')[1:16]"


def _word(i: int) -> str:
    return f"('0x' || digest[{1 + 8 * i}:{8 + 8 * i}])::BIGINT"


# 2^32 mod 730 = 616
_REST = _word(0) + " % 730"
for _i in (1, 2, 3):
    _REST = f"(({_REST}) * 616 + {_word(_i)}) % 730"
SHIFTED = (
    f"digests AS (SELECT *, md5(coalesce(PatientID, 'unknown') || '{SALT}') AS digest FROM inst)",
    f"shifted AS (SELECT *, (({_REST}) - 365)::INTEGER AS days FROM digests)",
)


def _date(c: str) -> str:
    return f"(CASE WHEN regexp_full_match({c}, '[0-9]{{8}}') THEN try_strptime({c}, '%Y%m%d') END)::DATE"


def _moved(c: str) -> str:
    return f"coalesce(strftime({_date(c)} + days, '%Y%m%d'), {c})"


_OVERFLOW = "(" + " OR ".join(f"coalesce(year({_date(c)} + days) NOT BETWEEN 1 AND 9999, false)" for c in _DATES) + ")"
_BAD_AGE = "coalesce(PatientAge LIKE '%Y' AND try_cast(regexp_replace(PatientAge, 'Y$', '') AS BIGINT) IS NULL, false)"
_AGE = """CASE WHEN PatientAge LIKE '%Y' AND try_cast(regexp_replace(PatientAge, 'Y$', '') AS BIGINT) > 89
    THEN '090Y' ELSE PatientAge END"""
_FAILURE = f"""CASE WHEN {_BAD_AGE} THEN 'PatientAge is not a number of years'
    WHEN {_OVERFLOW} THEN 'date shift leaves the calendar' END"""
FAILING = (*SHIFTED, f"treated AS (SELECT *, {_FAILURE} AS failure FROM shifted)")

_ERRORS = [
    (f"{tag} IS NULL", f"'Missing required tag: {tag}'")
    for tag in ("SOPInstanceUID", "StudyInstanceUID", "SeriesInstanceUID", "Modality")
]
_SIZED = 'coalesce("Rows" <> 0 AND "Columns" <> 0, false)'
_WARNINGS = [
    (
        "Modality NOT IN ('CT', 'MR', 'CR', 'DX', 'XA', 'PT', 'NM', 'US')",
        "'Modality ''' || Modality || ''' may not be fully supported'",
    ),
    (
        f'({_SIZED} AND ("Rows" < 64 OR "Columns" < 64))',
        """'Image dimensions (' || "Rows" || 'x' || "Columns" || ') are unusually small'""",
    ),
    (f"NOT {_SIZED}", "'Image dimensions not found'"),
    ("NOT has_pixel_data", "'No pixel data found'"),
]


def _messages(entries: list[tuple[str, str]], separator: str = "; ", lead: str = "") -> str:
    return f"concat_ws('{separator}', " + ", ".join(f"CASE WHEN {c} THEN '{lead}' || {m} END" for c, m in entries) + ")"


def _any(entries: list[tuple[str, str]]) -> str:
    return "(" + " OR ".join(f"coalesce({c}, false)" for c, _ in entries) + ")"


_LF = "' || chr(10) || '"


def _section(title: str, entries: list[tuple[str, str]]) -> str:
    lines = ", ".join(f"CASE WHEN {c} THEN '  - ' || {m} END" for c, m in entries)
    return f"CASE WHEN {_any(entries)} THEN chr(10) || '{title}:' END, {lines}"


_STORED = """stored AS (SELECT doc_id, 'raw/' || source || '/doc-' || doc_id || '.dcm' AS key, n_chars AS size,
    DATE '2024-01-01' + (doc_id % 400)::INTEGER AS modified, md5(text) AS etag, source,
    CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'application/dicom' ELSE 'binary/octet-stream' END AS content_type
    FROM documents)"""
_REQUESTED = """requested AS (SELECT DISTINCT 'raw/src' || ((event_id // 2) % 20) || '/doc-' || (event_id // 2) || '.dcm'
    AS object_key FROM events)"""
_LOG = """log AS (SELECT event_id, ts, event_type || ' ' || props AS message, event_type AS operation,
    CASE WHEN event_type = 'error' THEN 'error' WHEN event_id % 29 = 0 THEN 'failed' ELSE 'completed' END AS status,
    CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level FROM events)"""
_SECONDS = "'%Y-%m-%d %H:%M:%S'"
_CSV = f"""records AS (SELECT o_orderkey AS record_id,
    CASE WHEN o_orderkey % 41 <> 0 THEN 'P' || o_custkey END AS patient_id,
    CASE WHEN o_orderkey % 43 = 0 THEN '2025-13-32' WHEN o_orderkey % 47 = 0 THEN NULL
        WHEN o_orderkey % 53 = 0 THEN '2025/01/01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS study_date,
    CASE WHEN o_orderkey % 59 = 0 THEN 'X' WHEN o_orderkey % 61 = 0 THEN NULL
        ELSE {_pick("o_orderkey", ["CT", "MR", "CR"])} END AS modality,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'ACC' || o_orderkey END AS accession_number,
    {_pick("o_orderkey", ["pending", "completed", "failed", "done", None])} AS status FROM orders)"""
_CSV_RULES = {
    "V1": "(patient_id IS NULL OR length(patient_id) < 1)",
    "V2": "(study_date IS NULL OR NOT regexp_full_match(study_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}'))",
    "V3": """(regexp_full_match(study_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
        AND try_strptime(study_date, '%Y-%m-%d') IS NULL)""",
    "V4": "(modality IS NULL OR length(modality) < 2)",
    "V5": "status NOT IN ('pending', 'completed', 'failed')",
}


def _where_blank(comparison: str) -> str:
    """The names of the side-record columns that are blank (``=``) or filled (``<>``)."""
    names = ("patient_id", "study_date", "modality", "accession_number")
    return ", ".join(f"CASE WHEN coalesce({c}, '') {comparison} '' THEN '{c}' END" for c in names)


_JSON_PAIRS = " || ',' || ".join(
    f"""'"{c}":' || coalesce('"' || {c} || '"', 'null')"""
    for c in ("patient_id", "study_date", "modality", "accession_number", "status")
)
_RUNS = f"""runs AS (SELECT o_orderkey, o_custkey, o_orderstatus, 'run-' || o_orderkey AS name,
    CASE o_orderstatus WHEN 'O' THEN 'RUNNING' WHEN 'F' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
    o_orderdate AS started, strftime(o_orderdate, {_SECONDS}) AS start_date,
    CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate + to_seconds(o_orderkey % 600), {_SECONDS}) END AS stop_date
    FROM orders)"""
_FILES = """files AS (SELECT 'P' || o_custkey AS patient_id, '1.2.840.' || o_orderkey AS study_instance_uid,
    'raw/study-' || l_orderkey || '/' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '.dcm' AS file_path,
    trunc(l_extendedprice)::BIGINT AS file_size FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_MANIFEST_ID = """'MAN-' || sha256(coalesce(length(patient_id) || ':' || patient_id, '-') || '|'
    || coalesce(length(study_instance_uid) || ':' || study_instance_uid, '-'))[1:24]"""


def _numbered(most: int) -> str:
    """Files with the number of their document, ``most`` files each in path order."""
    order = "ORDER BY file_path, file_size, md5(file_path)"
    return f"""{_FILES}, numbered AS (SELECT *,
        ((row_number() OVER (PARTITION BY patient_id, study_instance_uid {order}) - 1) // {most})::INTEGER AS part,
        ((count(*) OVER (PARTITION BY patient_id, study_instance_uid) + {most - 1}) // {most})::INTEGER AS parts FROM files)"""


_STAGES = (
    *FAILING,
    f"""runs AS (SELECT path AS key, SeriesDate AS version, {_codes(RECORD)} = '' AS i, {_codes(SIDE)} = '' AS v,
        failure IS NULL AS d FROM treated)""",
    """overall AS (SELECT key, version, CASE WHEN bool_and(i) THEN 'success' ELSE 'failed' END AS ingestion_status,
        CASE WHEN bool_and(v) THEN 'valid' ELSE 'invalid' END AS validation_status,
        CASE WHEN bool_and(d) THEN 'success' ELSE 'failed' END AS deidentification_status,
        CASE WHEN bool_and(i AND v AND d) THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM runs GROUP BY key, version)""",
)
_ROUTED = f"""SELECT path, outcome, codes AS error_codes, failure,
    CASE WHEN outcome = 'delivered' THEN {_hash("PatientID")} END AS PatientID,
    CASE WHEN outcome = 'delivered' THEN {_AGE} END AS PatientAge,
    CASE WHEN outcome = 'delivered' THEN {_moved("StudyDate")} END AS StudyDate,
    CASE WHEN outcome = 'delivered' THEN Modality END AS Modality
    FROM (SELECT *, CASE WHEN codes <> '' THEN 'quarantined' WHEN failure IS NOT NULL THEN 'failed'
        ELSE 'delivered' END AS outcome FROM (SELECT *, {_codes(RECORD)} AS codes FROM treated))"""
_GROUP = "CASE WHEN upper(Modality) IN ('CT', 'MR', 'CR', 'DX', 'XA', 'PT', 'NM', 'US') THEN upper(Modality) ELSE 'OTHER' END"
_RUN_METRICS = f"""SELECT 'MedicalImaging/' || family AS namespace, name, 'Count' AS unit, dimension, count(*)::DOUBLE AS value FROM (
    SELECT 'Ingestion' AS family, 'FilesProcessed' AS name, 'Modality=' || {_GROUP} AS dimension FROM inst WHERE {_codes(RECORD)} = ''
    UNION ALL SELECT 'Validation', CASE WHEN v THEN 'ValidationSuccess' ELSE 'ValidationFailure' END, '' FROM runs
    UNION ALL SELECT 'Deidentification', CASE WHEN d THEN 'FilesDeidentified' ELSE 'DeidentificationFailure' END, '' FROM runs
    UNION ALL SELECT 'Pipeline', CASE WHEN i AND v AND d THEN 'PipelineSuccess' ELSE 'PipelineFailure' END, '' FROM runs
    UNION ALL SELECT 'Pipeline', 'Files', 'Outcome=' || CASE WHEN NOT i THEN 'quarantined' WHEN NOT d THEN 'failed' ELSE 'delivered' END
        FROM runs) GROUP BY ALL"""
_XML = """SELECT 'P' || o_custkey AS patient_id, 'N' || o_custkey AS patient_name, NULL::VARCHAR AS dob,
    '1.2.' || o_orderkey AS study_uid, strftime(o_orderdate, '%Y%m%d') AS study_date, 'CT' AS modality,
    (o_orderkey % 3 + 1)::INTEGER AS items,
    (['series 10', 'series 10,series 20', 'series 10,series 20,series 30'])[o_orderkey % 3 + 1] AS item_texts,
    ([1, 3, 6])[o_orderkey % 3 + 1] AS number_sum, o_orderpriority AS protocol,
    (o_orderkey % 200)::DOUBLE AS kvp, (o_orderkey % 7)::DOUBLE + 0.5 AS slice_thickness FROM orders"""
_TRIMMED_RECORDS = f"""nested AS (SELECT *, {_STRIPPED} AS stripped, upper(Modality) AS upper_modality,
    {_whole("InstanceNumber")} AS number,
    Modality = 'CT' AND coalesce(KVP, SliceThickness, ReconstructionDiameter) IS NOT NULL AS own_ct,
    Modality = 'MR' AND coalesce(RepetitionTime, EchoTime, MagneticFieldStrength) IS NOT NULL AS own_mr FROM inst)"""
_MIXED = (
    _TRIMMED_RECORDS,
    """mixed AS (SELECT *, coalesce(number = 2, false) AS given_ct, coalesce(number = 3, false) AS given_mr,
        coalesce(number = 2, false) OR coalesce(own_ct, false) AS has_ct,
        coalesce(number = 3, false) OR coalesce(own_mr, false) AS has_mr FROM nested)""",
)
_CROSS = {"X1": "(upper_modality = 'CT' AND has_mr)", "X2": "(upper_modality = 'MR' AND has_ct)"}


#: The flat rules; a block that was put in is judged by its own values, of which only -1 breaks a rule.
_NESTED_RULES = {
    **PATIENT,
    **STUDY,
    **SERIES,
    **IMAGE,
    **{c: f"(NOT given_ct AND coalesce(own_ct, false) AND {b})" for c, b in _CT.items()},
    "C3": f"(given_ct OR (coalesce(own_ct, false) AND {_CT['C3']}))",
    **{c: f"(NOT given_mr AND coalesce(own_mr, false) AND {b})" for c, b in _MR.items()},
    **INSTANCE,
    **_CROSS,
}
_FIELD_OF = {
    "P1": "patient_id", "P2": "patient_id", "P3": "patient_sex", "P4": "patient_age", "P5": "patient_age",
    "S1": "study_instance_uid", "S2": "study_instance_uid", "S3": "study_date", "S4": "study_date",
    "S5": "study_time", "S6": "study_description", "E1": "series_instance_uid", "E2": "series_instance_uid",
    "E3": "series_number", "E4": "series_description", "E5": "modality", "I1": "rows", "I2": "columns",
    "I3": "bits_allocated", "I4": "bits_stored", "I5": "pixel_spacing", "I6": "bits_stored", "C1": "kvp",
    "C2": "slice_thickness", "C3": "reconstruction_diameter", "M1": "repetition_time", "M2": "echo_time",
    "M3": "magnetic_field_strength", "N1": "sop_instance_uid", "N2": "sop_class_uid", "N3": "instance_number",
}
_HEADER = "PatientID PatientName PatientSex PatientAge InstitutionName StudyInstanceUID StudyDate SeriesInstanceUID SeriesNumber Modality SOPInstanceUID KVP".split()


def _readable(value: str, name: str) -> str:
    return f"CASE WHEN PatientSex <> 'X' THEN {value} END AS {name}"


_URI = """uris AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_replace(url, '^https?://', 's3://')
    WHEN page_id % 5 = 0 THEN 's3://lonely-' || page_id ELSE url END AS uri FROM pages)"""
_KEYED = """keyed AS (SELECT page_id, CASE WHEN uri LIKE 's3://%' AND regexp_extract(uri, '^s3://[^/]*/(.*)$', 1) <> ''
    THEN regexp_extract(uri, '^s3://[^/]*/(.*)$', 1) ELSE uri END AS key FROM uris)"""

ORACLE: dict[str, str] = {
    # --- sources
    "src_dicom_headers": _over(
        "SELECT path, "
        + ", ".join(_readable(f"rtrim(ltrim({c}, ' '), ' ')", c) for c in _HEADER)
        + ", "
        + ", ".join(
            _readable(f"({value})::VARCHAR", name)
            for value, name in (
                ('"Rows" % 65536', '"Rows"'),
                ('"Columns"', '"Columns"'),
                ("BitsAllocated", "BitsAllocated"),
                ("has_pixel_data", "has_pixel_data"),
            )
        )
        + ", CASE WHEN PatientSex = 'X' THEN 'no DICOM preamble' END AS parse_error FROM inst"
    ),
    "src_csv": f"""WITH {_CSV} SELECT patient_id, study_date, modality, accession_number, status,
        NULL::VARCHAR AS _corrupt_record FROM records""",
    "src_json": """SELECT '1.2.840.' || o_orderkey AS study_instance_uid, 'P' || o_custkey AS patient_id,
        strftime(o_orderdate, '%Y%m%d') AS study_date, 'CT' AS modality, o_orderpriority AS institution,
        CASE WHEN o_orderkey % 5 <> 0 THEN 'Dr^A' END AS referring_physician,
        (o_orderkey % 3 + 1)::INTEGER AS series_count,
        array_to_string(list_transform(range(1, (o_orderkey % 3 + 2)), lambda n: '1.2.' || o_orderkey || '.' || n), ',') AS series_uids,
        ([1, 3, 6])[o_orderkey % 3 + 1] AS number_sum, NULL::VARCHAR AS _corrupt_record FROM orders""",
    "src_xml": _XML,
    "src_dicom_scan": _over(
        "SELECT folder, "
        + ", ".join(_readable(f"rtrim(ltrim({c}, ' '), ' ')", c) for c in _HEADER)
        + ", "
        + ", ".join(_readable(f"({value})::VARCHAR", value) for value in ('"Rows"', '"Columns"', "BitsAllocated", "has_pixel_data"))
        + ", CASE WHEN PatientSex = 'X' THEN 'no DICOM preamble' END AS parse_error FROM files",
        """files AS (SELECT DISTINCT regexp_extract(path, 'raw/([^/]+)/', 1) AS folder, """
        + ", ".join(_HEADER)
        + """, "Rows" % 65536 AS "Rows", "Columns", BitsAllocated, has_pixel_data FROM inst)""",
    ),
    "src_list_tree": """SELECT 'web/h-' || regexp_replace(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '[^A-Za-z0-9.-]', '_', 'g')
        || '/' || (page_id % 13) || '/page-' || page_id || '.html' AS key, strlen(coalesce(html, '')) AS size,
        md5(coalesce(html, '')) AS etag FROM pages""",
    "src_csv_large": """SELECT doc_id::VARCHAR AS doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        length(coalesce(text, '')) AS n_chars, md5(coalesce(text, '')) AS text_md5, NULL::VARCHAR AS _corrupt_record FROM documents""",
    "src_stream_distinct": f"""SELECT event_id, bucket, key, size, 'v' || event_id AS version,
        strftime(TIMESTAMP '2024-01-01' + to_seconds(event_id % 600), {_SECONDS}) AS event_time FROM (
        SELECT page_id AS event_id, 'incoming' AS bucket, key, length(html) AS size FROM (
        SELECT page_id, html, unnest(['in box/' || url || CASE WHEN page_id % 3 <> 0 THEN '.dcm' ELSE '.txt' END,
            'second/' || page_id || ' a.dcm']) AS key FROM pages) WHERE key LIKE '%.dcm')""",
    "src_list_objects": f"""WITH {_STORED} SELECT key, size, strftime(modified, {_SECONDS}) AS last_modified, etag
        FROM stored WHERE key LIKE 'raw/src1%' ORDER BY key LIMIT 1000""",
    "src_arrivals": """SELECT page_id AS event_id, 'incoming' AS bucket, key, length(html) AS size FROM (
        SELECT page_id, html, unnest(['in box/' || url || CASE WHEN page_id % 3 <> 0 THEN '.dcm' ELSE '.txt' END,
            'second/' || page_id || ' a.dcm']) AS key FROM pages) WHERE key LIKE '%.dcm'""",
    "src_log_events": f"""WITH {_LOG} SELECT event_id, strftime(ts, {_SECONDS}) AS ts, message FROM log
        WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' ORDER BY log.ts, event_id LIMIT 100""",
    # --- sinks
    "snk_validated": _over(
        f"""SELECT path, 'validated/' || path AS validated_key, {_STRIPPED} AS patient_id,
        StudyInstanceUID AS study_uid, upper(Modality) AS modality FROM inst WHERE {_codes(RECORD)} = ''"""
    ),
    "snk_deidentified": _over(
        f"""SELECT path, 'deidentified/' || path AS deidentified_key, 'true' AS deidentified,
        {_hash("PatientID")} AS PatientID, {_moved("StudyDate")} AS StudyDate, Modality
        FROM treated WHERE failure IS NULL""",
        *FAILING,
    ),
    "snk_execution_log": _over(
        f"""SELECT 'parse_and_validate' AS operation, CASE WHEN codes = '' THEN 'completed' ELSE 'failed' END AS status,
        path AS file_path, CASE WHEN codes <> '' THEN 'ValidationError' END AS error_type,
        CASE WHEN codes <> '' THEN codes END AS error_message, '2025-01-01 00:00:00' AS ts
        FROM (SELECT path, {_codes(RECORD)} AS codes FROM inst)"""
    ),
    "snk_metrics": _over(
        f"""SELECT 'MedicalImaging/Ingestion' AS namespace, 'FilesProcessed' AS name, count(*)::DOUBLE AS value,
        'None' AS unit, upper(Modality) AS modality, '2025-01-01 00:00:00' AS ts
        FROM inst WHERE {_codes(RECORD)} = '' GROUP BY upper(Modality)"""
    ),
    "snk_run_metrics": _over(_RUN_METRICS, *_STAGES),
    "snk_log_events": f"""WITH {_LOG} SELECT '/imaging/ingestion' AS log_group, 'stream-' || level AS log_stream,
        strftime(ts, {_SECONDS}) AS ts, unnest([operation || ' started', message]) AS message FROM log""",
    # --- projections
    "prj_base_metadata": _over(
        """SELECT path, PatientID AS patient_id, coalesce(PatientName, '') AS patient_name,
        PatientBirthDate AS patient_birth_date, PatientSex AS patient_sex, PatientAge AS patient_age,
        StudyInstanceUID AS study_instance_uid, StudyDate AS study_date, StudyTime AS study_time,
        StudyDescription AS study_description, AccessionNumber AS accession_number,
        SeriesInstanceUID AS series_instance_uid, SeriesNumber AS series_number,
        SeriesDescription AS series_description, Modality AS modality, SOPInstanceUID AS sop_instance_uid,
        SOPClassUID AS sop_class_uid, InstanceNumber AS instance_number, "Rows"::VARCHAR AS "rows",
        "Columns"::VARCHAR AS "columns", BitsAllocated::VARCHAR AS bits_allocated, BitsStored::VARCHAR AS bits_stored,
        coalesce(array_to_string(list_transform(PixelSpacing, lambda x: (x * 10)::INTEGER), '/'), '') AS pixel_spacing FROM inst"""
    ),
    "prj_modality_metadata": _over(
        "SELECT path, Modality AS modality, "
        + ", ".join(
            f"CASE WHEN Modality = '{m}' THEN {tag} END AS {name}"
            for m, tag, name in (
                ("CT", "KVP", "kvp"),
                ("CT", "SliceThickness", "slice_thickness"),
                ("CT", "ReconstructionDiameter", "reconstruction_diameter"),
                ("MR", "RepetitionTime", "repetition_time"),
                ("MR", "EchoTime", "echo_time"),
                ("MR", "MagneticFieldStrength", "magnetic_field_strength"),
            )
        )
        + " FROM inst"
    ),
    "prj_nested_records": _over(
        f"""SELECT path, stripped AS patient_id, StudyInstanceUID AS study_instance_uid,
        {_whole("SeriesNumber")}::INTEGER::VARCHAR AS series_number, upper_modality AS modality,
        number::INTEGER::VARCHAR AS instance_number, {_HAS_IMAGE} AS has_image,
        CASE WHEN {_HAS_IMAGE} THEN "Rows"::VARCHAR END AS image_rows,
        CASE WHEN {_HAS_IMAGE} THEN BitsStored::VARCHAR END AS image_bits_stored,
        coalesce(own_ct, false) AS has_ct, CASE WHEN own_ct THEN {_real("KVP")} END AS ct_kvp,
        coalesce(own_mr, false) AS has_mr, CASE WHEN own_mr THEN {_real("MagneticFieldStrength")} END AS mr_field
        FROM nested""",
        _TRIMMED_RECORDS,
    ),
    "prj_tag_default": _over(
        """SELECT path, coalesce(StudyDescription, 'none given') AS study_description, l_returnflag AS body_part,
        'absent' AS no_such_tag, AccessionNumber AS accession_number FROM inst"""
    ),
    "prj_xml_record": _XML,
    "prj_row_records": f"""WITH {_CSV} SELECT '{{"record_id":' || record_id || ',' || {_JSON_PAIRS} || '}}' AS record
        FROM records""",
    "prj_summary": _over(
        f"""SELECT path, concat_ws(chr(10), 'DICOM File Summary', repeat('=', 50),
        'Modality: ' || coalesce(Modality, 'None'), 'Study UID: ' || coalesce(StudyInstanceUID, 'None'),
        'Series UID: ' || coalesce(SeriesInstanceUID, 'None'),
        'SOP Instance UID: ' || coalesce(SOPInstanceUID, 'None'),
        'Dimensions: ' || coalesce("Rows"::VARCHAR, 'None') || 'x' || coalesce("Columns"::VARCHAR, 'None'),
        CASE WHEN {_any(_ERRORS)} THEN 'Valid: No' ELSE 'Valid: Yes' END,
        {_section("Errors", _ERRORS)}, {_section("Warnings", _WARNINGS)}) AS summary FROM inst"""
    ),
    "prj_object_keys": f"""WITH {_URI}, {_KEYED} SELECT page_id, key, split(key, '/')[-1] AS base_name,
        'validated/' || key AS validated_key, 'deidentified/' || key AS deidentified_key FROM keyed""",
    "prj_content_md5": "SELECT doc_id, md5(text) AS md5 FROM documents",
    "prj_grants": f"""WITH {_STORED} SELECT key AS object_key, 'delivery' AS bucket, 'get_object' AS client_method,
        3600 AS expires_in, '2025-01-01 01:00:00' AS expires_at, 'application/dicom' AS response_content_type,
        'attachment; filename="' || split(key, '/')[-1] || '"' AS response_content_disposition,
        NULL::VARCHAR AS content_type, NULL::VARCHAR AS upload_origin, 'get_object' AS asked_method FROM stored
        UNION ALL SELECT key, 'delivery', 'put_object', 900, '2025-01-01 00:15:00', NULL, NULL, 'application/dicom',
        'scanner', 'put_object' FROM stored""",
    "prj_normalized": _over(f"SELECT path, {_STRIPPED} AS patient_id, upper(Modality) AS modality FROM inst"),
    # --- validation
    "val_structural": _over(
        f"""SELECT path, {_messages(_ERRORS)} AS errors, {_messages(_WARNINGS)} AS warnings,
        NOT {_any(_ERRORS)} AS is_valid FROM inst"""
    ),
    "val_required_fields": f"""WITH {_CSV} SELECT record_id,
        concat_ws(',', {_where_blank("=")}, 'no_such_field') AS missing_fields,
        concat_ws(',', {_where_blank("<>")}) AS present_fields, false AS is_valid FROM records""",
    "val_patient": _over(_verdict(PATIENT)),
    "val_study": _over(_verdict(STUDY)),
    "val_series": _over(_verdict(SERIES)),
    "val_image": _over(_verdict(IMAGE)),
    "val_modality": _over(_verdict(MODALITY)),
    "val_instance": _over(_verdict(INSTANCE)),
    "val_cross_model": _over(_verdict(_CROSS, "mixed"), *_MIXED),
    "val_nested_record": _over(_verdict(_NESTED_RULES, "mixed"), *_MIXED),
    "val_typed_record": _over(
        f"""SELECT path, stripped AS patient_id, {_whole("SeriesNumber")}::INTEGER::VARCHAR AS series_number,
        number::INTEGER::VARCHAR AS instance_number, CASE WHEN {_HAS_IMAGE} THEN "Rows"::VARCHAR END AS image_rows,
        CASE WHEN own_ct THEN {_real("KVP")} END AS ct_kvp, CASE WHEN own_mr THEN {_real("MagneticFieldStrength")} END AS mr_field,
        {_codes(RECORD)} AS error_codes FROM nested""",
        _TRIMMED_RECORDS,
    ),
    "val_csv_record": f"WITH {_CSV} " + _verdict(_CSV_RULES, "records", "record_id"),
    "val_manifest": """WITH declared AS (SELECT CASE WHEN o_orderkey % 301 = 0 THEN '' ELSE 'M' || o_orderkey END AS manifest_id,
        CASE WHEN o_orderkey % 31 = 0 OR o_orderkey % 37 = 0 THEN false ELSE true END AS dated,
        o_orderkey % 41 = 0 AS no_patient, o_orderkey % 43 = 0 AS no_study, o_orderkey % 9 - 1 AS total_files,
        trunc(o_totalprice)::BIGINT - CASE WHEN o_orderkey % 47 = 0 THEN 1000000000 ELSE 0 END AS total_size FROM orders),
        counted AS (SELECT 'M' || l_orderkey AS manifest_id, count(*) AS n, bool_or(l_partkey % 401 = 0) AS f1,
        bool_or(trunc(l_extendedprice)::BIGINT - CASE WHEN l_partkey % 409 = 0 THEN 10000000 ELSE 0 END < 0) AS f2,
        bool_or(l_partkey % 419 = 0) AS f3 FROM lineitem GROUP BY l_orderkey),
        judged AS (SELECT manifest_id, coalesce(n, 0) AS actual_files, concat_ws(',',
        CASE WHEN manifest_id = '' THEN 'D1' END, CASE WHEN no_patient THEN 'D2' END, CASE WHEN no_study THEN 'D3' END, CASE WHEN NOT dated THEN 'D4' END,
        CASE WHEN total_files < 0 THEN 'D5' END, CASE WHEN total_size < 0 THEN 'D6' END,
        CASE WHEN f1 THEN 'F1' END, CASE WHEN f2 THEN 'F2' END, CASE WHEN f3 THEN 'F3' END,
        CASE WHEN coalesce(n, 0) <> total_files THEN 'D7' END) AS codes
        FROM declared LEFT JOIN counted USING (manifest_id))
        SELECT manifest_id, actual_files, codes AS error_codes, codes = '' AS is_valid FROM judged""",
    "val_record": _over(_verdict(RECORD)),
    "val_record_details": _over(
        " UNION ALL ".join(
            f"SELECT '{code}' AS rule, '{_FIELD_OF[code]}' AS field, count(*) AS rows_broken FROM inst WHERE {broken}"
            " HAVING count(*) > 0"
            for code, broken in RECORD.items()
        )
    ),
    "val_side_metadata": _over(_verdict(SIDE)),
    "val_split": _over(
        f"""SELECT path, CASE WHEN codes = '' THEN 'valid' ELSE 'invalid' END AS status,
        CASE WHEN codes = '' THEN {_STRIPPED} END AS patient_id,
        CASE WHEN codes = '' THEN StudyInstanceUID END AS study_uid,
        CASE WHEN codes = '' THEN upper(Modality) END AS modality, CASE WHEN codes <> '' THEN codes END AS error,
        CASE WHEN codes <> '' THEN 'ValidationError' END AS error_type
        FROM (SELECT *, {_codes(SIDE)} AS codes FROM inst)"""
    ),
    # --- joins
    "join_merge_metadata": f"""WITH {_CSV}, last AS (SELECT l_orderkey, arg_max(l_returnflag,
        l_linenumber || '-' || l_partkey || '-' || l_suppkey) AS status,
        max(l_linenumber || '-' || l_partkey || '-' || l_suppkey) AS line FROM lineitem GROUP BY l_orderkey)
        SELECT record_id, patient_id,
        CASE WHEN record_id % 2 = 0 THEN CASE WHEN record_id % 4 = 0 THEN 'XR' END ELSE modality END AS modality,
        CASE WHEN last.l_orderkey IS NOT NULL THEN last.status ELSE records.status END AS status,
        CASE WHEN record_id % 2 = 0 THEN o_orderpriority END AS priority, line
        FROM records JOIN orders ON o_orderkey = record_id LEFT JOIN last ON last.l_orderkey = record_id""",
    "join_merge_maps": """SELECT o_orderkey, o_orderkey::VARCHAR AS id,
        CASE WHEN o_orderkey % 3 = 0 THEN 'merged' END AS status, o_orderpriority AS priority, 3 AS entries FROM orders""",
    "join_object_exists": f"""WITH {_STORED}, {_REQUESTED} SELECT object_key, key IS NOT NULL AS object_exists
        FROM requested LEFT JOIN stored ON key = object_key""",
    "join_object_metadata": f"""WITH {_STORED}, {_REQUESTED} SELECT key, size,
        strftime(modified, {_SECONDS}) AS last_modified, etag, coalesce(content_type, 'unknown') AS content_type, source
        FROM requested JOIN stored ON key = object_key""",
    "join_verify_transfer": f"""WITH {_STORED}, local AS (SELECT CASE WHEN doc_id % 13 = 0 OR doc_id % 11 = 0 THEN 'stray/' ELSE '' END
        || 'raw/' || source || '/doc-' || doc_id || '.dcm' AS key,
        md5(CASE WHEN doc_id % 7 = 0 THEN text || chr(10) ELSE text END) AS checksum FROM documents)
        SELECT key, size::VARCHAR AS size, checksum, etag, coalesce(checksum = etag, false) AS checksum_verified
        FROM local FULL JOIN stored USING (key)""",
    "join_batch_grants": f"""WITH {_STORED}, {_REQUESTED} SELECT object_key,
        CASE WHEN key IS NOT NULL THEN '3600' END AS expires_in,
        CASE WHEN key IS NOT NULL THEN '2025-01-01 01:00:00' END AS expires_at, key IS NOT NULL AS granted
        FROM requested LEFT JOIN stored ON key = object_key""",
    "join_secure_grants": f"""WITH {_STORED}, {_REQUESTED} SELECT object_key, key IS NOT NULL AS object_exists,
        CASE WHEN key IS NOT NULL THEN 'delivery' END AS bucket,
        CASE WHEN key IS NOT NULL THEN '2025-01-01 02:00:00' END AS expires_at,
        CASE WHEN key IS NOT NULL THEN 'application/dicom' END AS response_content_type,
        CASE WHEN key IS NOT NULL THEN 'attachment; filename="' || split(key, '/')[-1] || '"' END
            AS response_content_disposition FROM requested LEFT JOIN stored ON key = object_key""",
    "join_pipeline_results": _over("SELECT * FROM overall", *_STAGES),
    "join_stage_versions": """SELECT e.user_id AS key, e.event_id, e.event_type AS stage, arg_max(u.event_id, (u.ts, u.event_id))::VARCHAR AS version
        FROM events e LEFT JOIN events u ON u.event_type = 'purchase' AND u.user_id = e.user_id AND u.ts <= e.ts
        WHERE e.event_type <> 'purchase' GROUP BY e.user_id, e.event_id, e.event_type""",
    # --- aggregations
    "agg_files_by_modality": _over(
        f"""SELECT upper(Modality) AS modality, count(*) AS files_processed FROM inst
        WHERE {_codes(RECORD)} = '' GROUP BY upper(Modality)"""
    ),
    "agg_validation_counts": _over(
        f"""SELECT count(*) FILTER (codes = '') AS validation_success, count(*) FILTER (codes <> '') AS validation_failure
        FROM (SELECT {_codes(SIDE)} AS codes FROM inst)"""
    ),
    "agg_deid_counts": _over(
        """SELECT count(*) FILTER (failure IS NULL) AS files_deidentified,
        count(*) FILTER (failure IS NOT NULL) AS deidentification_failure FROM treated""",
        *FAILING,
    ),
    "agg_pipeline_outcomes": _over(
        """SELECT handler || upper(outcome[1]) || outcome[2:] AS metric_name, handler, outcome, count(*) AS count FROM (
        SELECT 'Ingestion' AS handler, CASE WHEN i THEN 'success' ELSE 'failure' END AS outcome FROM runs
        UNION ALL SELECT 'Validation', CASE WHEN v THEN 'success' ELSE 'failure' END FROM runs
        UNION ALL SELECT 'Deidentification', CASE WHEN d THEN 'success' ELSE 'failure' END FROM runs
        UNION ALL SELECT 'Pipeline', CASE status WHEN 'SUCCESS' THEN 'success' ELSE 'failure' END FROM overall)
        GROUP BY handler, outcome""",
        *_STAGES,
    ),
    "agg_batch_results": _over(
        f"""SELECT coalesce(StudyDate, 'none') AS batch_id, count(*) AS processed,
        count(*) FILTER (codes = '') AS succeeded, count(*) FILTER (codes <> '') AS failed
        FROM (SELECT StudyDate, {_codes(RECORD)} AS codes FROM inst) GROUP BY coalesce(StudyDate, 'none')"""
    ),
    "agg_manifests": f"""WITH {_FILES} SELECT {_MANIFEST_ID} AS manifest_id, '2025-01-01T00:00:00Z' AS created_at,
        patient_id, study_instance_uid, count(*) AS total_files, sum(file_size)::BIGINT AS total_size_bytes
        FROM files GROUP BY patient_id, study_instance_uid""",
    "agg_manifest_files": f"""WITH {_FILES} SELECT {_MANIFEST_ID} AS manifest_id, file_path, file_size,
        md5(file_path) AS checksum FROM files""",
    "agg_manifest_documents": f"""WITH {_numbered(3)} SELECT {_MANIFEST_ID} AS manifest_id, part, parts, count(*) AS part_files,
        sum(file_size)::BIGINT AS part_size_bytes, string_agg(file_path, ',' ORDER BY file_path) AS paths
        FROM numbered GROUP BY patient_id, study_instance_uid, part, parts""",
    "val_manifest_array": f"""WITH {_numbered(4)}, listed AS (SELECT {_MANIFEST_ID} AS manifest_id, part, count(*) AS n_files,
        regexp_extract(study_instance_uid, '([0-9]+)$', 1)::BIGINT AS k FROM numbered GROUP BY patient_id, study_instance_uid, part)
        SELECT manifest_id, part, n_files, codes AS error_codes, codes = '' AS is_valid FROM (SELECT *, concat_ws(',',
        CASE WHEN k % 13 = 0 THEN 'D7' END, CASE WHEN k % 17 = 0 THEN 'F1' END, CASE WHEN k % 19 = 0 THEN 'F2' END,
        CASE WHEN k % 23 = 0 THEN 'F3' END) AS codes FROM listed)""",
    "agg_manifest_grants": f"""WITH {_FILES}, granted AS (SELECT DISTINCT 'raw/study-' || l_orderkey || '/' || l_linenumber || '-'
        || l_partkey || '-' || l_suppkey || '.dcm' AS k FROM lineitem WHERE l_partkey % 5 <> 0)
        SELECT {_MANIFEST_ID} AS manifest_id, file_path, CASE WHEN k IS NOT NULL THEN 'https://delivery/' || file_path END AS presigned_url,
        CASE WHEN k IS NOT NULL THEN '2025-01-01T01:00:00Z' END AS url_expiration FROM files LEFT JOIN granted ON k = file_path""",
    "agg_metric_rollup": f"""SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), {_SECONDS}) AS period_start,
        strftime(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR, {_SECONDS}) AS period_end,
        'MedicalImaging/Pipeline' AS namespace, event_type AS name, sum(value::DECIMAL(28, 6))::DOUBLE AS total,
        sum(value::DECIMAL(28, 6))::DOUBLE / count(value) AS average, max(value) AS maximum, count(value) AS points
        FROM events GROUP BY time_bucket(INTERVAL 1 HOUR, ts), event_type""",
    "agg_failure_alarms": f"""SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), {_SECONDS}) AS period_start,
        event_type AS name, sum(value::DECIMAL(28, 6))::DOUBLE AS total, count(value) AS points
        FROM events WHERE event_type = 'error' GROUP BY time_bucket(INTERVAL 5 MINUTE, ts), event_type
        HAVING sum(value) > 0""",
    "agg_phi_totals": _over(
        " UNION ALL ".join(
            f"SELECT '{tag}' AS tag, {f'count({tag})' if tag in _REMOVE + _HASH + _DATES else '0'} AS row_count"
            f" FROM {'inst' if tag in _REMOVE + _HASH + _DATES else '(SELECT 1)'}"
            for tag in _ALL_REMOVED + _HASH + _DATES
        )
    ),
    # --- limits, runs, retention
    "top_failed_operations": f"""WITH {_LOG} SELECT event_id, strftime(ts, {_SECONDS}) AS ts, operation, status, message
        FROM log WHERE status IN ('failed', 'error') ORDER BY log.ts DESC, event_id LIMIT 100""",
    "run_list": f"""WITH {_RUNS} SELECT 'arn:run:' || name AS execution_arn, name, status, start_date, stop_date
        FROM runs WHERE status = 'SUCCEEDED' ORDER BY started DESC, name LIMIT 100""",
    "run_describe": f"""WITH {_RUNS} SELECT 'arn:run:' || name AS execution_arn,
        'arn:machine:imaging' AS state_machine_arn, name, status, start_date, stop_date,
        'raw/' || o_orderkey || '.dcm' AS input_key, o_custkey AS input_patient,
        CASE WHEN o_orderstatus = 'P' THEN 'SUCCESS' END AS output_status,
        CASE WHEN o_orderstatus = 'P' THEN (o_orderkey % 9)::VARCHAR END AS output_files,
        CASE WHEN o_orderstatus = 'F' THEN 'PipelineExecutionFailed' END AS error,
        CASE WHEN o_orderstatus = 'F' THEN 'step ' || (o_orderkey % 3) || ' failed' END AS cause FROM runs""",
    "ret_storage_tiers": f"""WITH {_STORED} SELECT key, date_diff('day', modified, DATE '2025-03-01') AS age_days,
        CASE WHEN date_diff('day', modified, DATE '2025-03-01') >= 180 THEN 'GLACIER'
        WHEN date_diff('day', modified, DATE '2025-03-01') >= 90 THEN 'STANDARD_IA' ELSE 'STANDARD' END AS storage_class
        FROM stored""",
    "ret_unexpired_logs": f"""SELECT event_id, strftime(ts, {_SECONDS}) AS ts FROM events
        WHERE date_diff('day', events.ts::DATE, DATE '2024-04-10') < 90""",
    # --- de-identification
    "deid_remove_tags": _over(
        f"SELECT path, PatientID, PatientSex, StudyDate, '{_COLUMNS_LEFT}' AS columns_left, 1 AS tag_count FROM inst"
    ),
    "deid_hash_ids": _over(
        f"SELECT path, {_hash('PatientID')} AS PatientID, {_hash('AccessionNumber')} AS AccessionNumber FROM inst"
    ),
    "deid_date_shift": _over("SELECT path, days AS date_shift_days FROM shifted", *SHIFTED),
    "deid_shift_dates": _over(
        "SELECT path, shift_failed, "
        + ", ".join(f"CASE WHEN NOT shift_failed THEN {_moved(c)} END AS {c}" for c in _DATES)
        + f" FROM (SELECT *, {_OVERFLOW} AS shift_failed FROM shifted)",
        *SHIFTED,
    ),
    "deid_cap_age": _over(f"SELECT path, {_AGE} AS PatientAge, {_BAD_AGE} AS unreadable FROM inst"),
    "deid_remove_private_and_pixels": _over("SELECT path, 0 AS private_tags, false AS has_pixel_data FROM inst"),
    "deid_report": _over(
        """SELECT path, concat_ws(',', nullif(r, ''), nullif(h, ''), nullif(s, '')) AS phi_tags_present,
        r AS tags_to_remove, h AS tags_to_hash, s AS tags_to_shift, private_count AS private_tags_count, n AS total_phi_elements
        FROM (SELECT path, private_count, """
        + ", ".join(
            "concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN '{c}' END" for c in tags) + f") AS {name}"
            for tags, name in (([t for t in _ALL_REMOVED if t in _REMOVE], "r"), (_HASH, "h"), (_DATES, "s"))
        )
        + ", ("
        + " + ".join(f"({c} IS NOT NULL)::INTEGER" for c in _REMOVE + _HASH + _DATES)
        + ") AS n FROM inst)"
    ),
    "deid_phi_inventory": _over(
        "SELECT path, concat_ws(',', "
        + ", ".join(f"CASE WHEN {c} <> '' THEN '{c}' END" for c in _INVENTORY)
        + ") AS phi_tags FROM inst"
    ),
    "deid_dataset": _over(
        f"""SELECT path, {_hash("PatientID")} AS PatientID, PatientSex, {_AGE} AS PatientAge,
        {_hash("AccessionNumber")} AS AccessionNumber, StudyInstanceUID, """
        + ", ".join(f"{_moved(c)} AS {c}" for c in _DATES)
        + """, StudyTime, Modality, SOPInstanceUID, 'YES' AS PatientIdentityRemoved,
        'HIPAA Safe Harbor with date shifting and ID hashing' AS DeidentificationMethod, 0 AS private_tags
        FROM treated WHERE failure IS NULL""",
        *FAILING,
    ),
    "deid_failures": _over("SELECT path, SOPInstanceUID, failure FROM treated WHERE failure IS NOT NULL", *FAILING),
    "deid_audit": _over(
        f"""SELECT 'phi_deidentification' AS event_type, 'deidentification-service' AS "user",
        'DICOM:' || coalesce(SOPInstanceUID, 'unknown') AS resource, 'deidentify' AS action,
        CASE WHEN failure IS NULL THEN 'success' ELSE 'failure' END AS result,
        CASE WHEN failure IS NULL THEN coalesce({_hash("PatientID")}, '') ELSE '' END AS hashed_patient_id,
        days AS date_shift_days FROM treated""",
        *FAILING,
    ),
    "pipeline_batch": _over(_ROUTED, *FAILING),
    "stream_pipeline": _over(_ROUTED, *FAILING),
    "stream_alarm_changes": f"""WITH p AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS s, event_type AS name, sum(value::DECIMAL(28, 6)) > 0 AS alarm
        FROM events WHERE event_type = 'error' GROUP BY ALL),
        c AS (SELECT s, name FROM p UNION SELECT s + INTERVAL 5 MINUTE, name FROM p),
        j AS (SELECT c.s, c.name, coalesce(now.alarm, false) AS is_now, coalesce(before.alarm, false) AS was FROM c
            LEFT JOIN p now ON now.s = c.s AND now.name = c.name LEFT JOIN p before ON before.s = c.s - INTERVAL 5 MINUTE AND before.name = c.name)
        SELECT name, strftime(s, {_SECONDS}) AS period_start, CASE WHEN was THEN 'ALARM' ELSE 'OK' END AS from_state,
        CASE WHEN is_now THEN 'ALARM' ELSE 'OK' END AS to_state FROM j
        WHERE was <> is_now AND s + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events WHERE event_type = 'error')""",
    "stream_failure_alarms": f"""SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), {_SECONDS}) AS period_start,
        event_type AS name, sum(value::DECIMAL(28, 6))::DOUBLE AS total, count(*) AS points
        FROM events WHERE event_type = 'error' GROUP BY time_bucket(INTERVAL 5 MINUTE, ts), event_type
        HAVING sum(value) > 0""",
}

#: The capped reports without their limit, and arrivals as a stream.
for _name in ("src_list_objects", "src_log_events", "top_failed_operations", "run_list"):
    ORACLE[f"{_name}_all"] = ORACLE[_name][: ORACLE[_name].rindex("ORDER BY")]
ORACLE["src_stream_arrivals"] = ORACLE["src_arrivals"]
ORACLE["src_json_large"] = ORACLE["src_csv_large"]
ORACLE["stream_pipeline_metrics"] = ORACLE["snk_run_metrics"]
