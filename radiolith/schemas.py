"""Tag lists and table schemas.

Everything is declared: no reader in this library infers a schema, because inference
turns date strings into dates and numeric text into numbers before the rules see them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: tag lists of the de-identification policy -----------------------

REMOVE_TAGS = (
    "PatientName",
    "PatientBirthDate",
    "PatientAddress",
    "PatientTelephoneNumbers",
    "PatientMotherBirthName",
    "MilitaryRank",
    "BranchOfService",
    "MedicalRecordLocator",
    "InstitutionName",
    "InstitutionAddress",
    "InstitutionalDepartmentName",
    "ReferringPhysicianName",
    "ReferringPhysicianAddress",
    "ReferringPhysicianTelephoneNumbers",
    "PerformingPhysicianName",
    "NameOfPhysiciansReadingStudy",
    "OperatorsName",
    "RequestingPhysician",
    "StudyIDIssuer",
    "IssuerOfPatientID",
    "DeviceSerialNumber",
    "PlateID",
    "ProtocolName",
    "StationName",
    "OtherPatientIDs",
    "OtherPatientNames",
    "RegionOfResidence",
    "CurrentPatientLocation",
    "PatientInstitutionResidence",
)
HASH_TAGS = ("PatientID", "AccessionNumber")
DATE_TAGS = ("StudyDate", "SeriesDate", "AcquisitionDate", "ContentDate", "InstanceCreationDate")
TIME_TAGS = ("StudyTime", "SeriesTime", "AcquisitionTime", "ContentTime", "InstanceCreationTime")

# Tags the identifier inventory looks at. "OperatorName" is spelled without the "s" here
# and so never matches a real header; the spelling is part of the result to match.
INVENTORY_TAGS = (
    "PatientName",
    "PatientID",
    "PatientBirthDate",
    "PatientSex",
    "PatientAge",
    "PatientAddress",
    "PatientTelephoneNumbers",
    "InstitutionName",
    "InstitutionAddress",
    "ReferringPhysicianName",
    "PerformingPhysicianName",
    "OperatorName",
    "StudyDate",
    "StudyTime",
    "SeriesDate",
    "SeriesTime",
    "AcquisitionDate",
    "AcquisitionTime",
    "ContentDate",
    "ContentTime",
)
REQUIRED_TAGS = ("SOPInstanceUID", "StudyInstanceUID", "SeriesInstanceUID", "Modality")
SUPPORTED_MODALITIES = ("CT", "MR", "CR", "DX", "XA", "PT", "NM", "US")
DEID_METHOD = "HIPAA Safe Harbor with date shifting and ID hashing"

# --- Instances: one row per DICOM instance, columns named by DICOM keyword ----------

OTHER_TEXT_TAGS = (
    "PatientSex",
    "PatientAge",
    "StudyInstanceUID",
    "StudyDescription",
    "SeriesInstanceUID",
    "SeriesNumber",
    "SeriesDescription",
    "Modality",
    "SOPInstanceUID",
    "SOPClassUID",
    "InstanceNumber",
    "KVP",
    "SliceThickness",
    "ReconstructionDiameter",
    "RepetitionTime",
    "EchoTime",
    "MagneticFieldStrength",
    "PatientIdentityRemoved",
    "DeidentificationMethod",
)
INTEGER_TAGS = ("Rows", "Columns", "BitsAllocated", "BitsStored")
TEXT_TAGS = REMOVE_TAGS + HASH_TAGS + DATE_TAGS + TIME_TAGS + OTHER_TEXT_TAGS

HEADER_FIELDS = (
    [T.StructField(tag, T.StringType()) for tag in TEXT_TAGS]
    + [T.StructField(tag, T.IntegerType()) for tag in INTEGER_TAGS]
    + [
        T.StructField("PixelSpacing", T.ArrayType(T.DoubleType())),
        T.StructField("has_pixel_data", T.BooleanType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("private_tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("parse_error", T.StringType()),
    ]
)
FILE_FIELDS = [
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
]
INSTANCES = T.StructType(FILE_FIELDS + HEADER_FIELDS)

# --- Side files -------------------------------------------------------------------


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _INT, _LONG, _REAL, _TIME = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()
_TEXT_MAP = T.MapType(_TEXT, _TEXT)

CSV_RECORD = _struct(patient_id=_TEXT, study_date=_TEXT, modality=_TEXT, accession_number=_TEXT, status=_TEXT)
JSON_STUDY = _struct(
    study_instance_uid=_TEXT,
    patient_id=_TEXT,
    study_date=_TEXT,
    modality=_TEXT,
    institution=_TEXT,
    referring_physician=_TEXT,
    series=T.ArrayType(_struct(series_instance_uid=_TEXT, series_number=_INT, description=_TEXT)),
)
XML_STUDY = _struct(
    patient=_struct(_id=_TEXT, name=_TEXT, dob=_TEXT),
    study=_struct(
        _uid=_TEXT,
        _date=_TEXT,
        description=_TEXT,
        modality=_TEXT,
        series=_struct(item=T.ArrayType(_struct(_VALUE=_TEXT, _number=_INT))),
    ),
    acquisition=_struct(protocol=_TEXT, kvp=_REAL, slice_thickness=_REAL),
)

# --- Events and accounting tables ---------------------------------------------------

ARRIVAL_EVENT = _struct(
    Records=T.ArrayType(
        _struct(
            eventVersion=_TEXT,
            eventSource=_TEXT,
            eventName=_TEXT,
            eventTime=_TIME,
            s3=_struct(bucket=_struct(name=_TEXT), object=_struct(key=_TEXT, size=_LONG, versionId=_TEXT)),
        )
    )
)
METRICS = _struct(namespace=_TEXT, name=_TEXT, value=_REAL, unit=_TEXT, dimensions=_TEXT_MAP, ts=_TIME)
LOG_EVENTS = _struct(log_group=_TEXT, log_stream=_TEXT, ts=_TIME, message=_TEXT, ingestion_time=_TIME)
EXECUTION_LOG = _struct(
    ts=_TIME, operation=_TEXT, status=_TEXT, details=_TEXT_MAP, error=_struct(type=_TEXT, message=_TEXT)
)
