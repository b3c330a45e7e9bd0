"""Checks of extracted records against the allowed values of their fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import text as T

# The allowed values of each domain.
DOMAINS = {
    "person_role": ("perpetrator", "victim", "witness", "associate", "legal", "law_enforcement", "unknown"),
    "location_type": ("residence", "island", "airport", "office", "school", "hotel", "vehicle", "yacht", "property", "unknown"),
    "org_type": ("company", "foundation", "school", "government", "legal", "financial", "unknown"),
    "event_type": ("flight", "meeting", "transaction", "phone_call", "visit", "assault", "arrest", "testimony", "court_hearing", "deposition", "travel", "unknown"),
    "allegation_severity": ("critical", "severe", "moderate", "minor"),
    "allegation_status": ("confirmed_by_court", "alleged_under_oath", "alleged", "disputed", "rumored"),
    "association_nature": ("employer", "friend", "associate", "co-conspirator", "victim-perpetrator", "legal", "familial", "unknown"),
    "identity_document_type": ("passport", "drivers_license", "birth_certificate", "ssn_card", "visa", "id_card", "unknown"),
    "communication_type": ("email", "phone_call", "text_message", "letter", "fax", "unknown"),
    "legal_document_type": ("subpoena", "deposition", "warrant", "affidavit", "court_order", "motion", "indictment", "plea_agreement", "testimony", "unknown"),
    "transaction_type": ("wire_transfer", "check", "cash", "credit_card", "payment", "unknown"),
    "physical_evidence_type": ("document", "photograph", "recording", "device", "vehicle", "clothing", "other"),
    "redaction_type": ("name", "address", "phone", "email", "account_number", "identifier", "unknown"),
    "confidence": ("high", "medium", "low"),
}

#: Category (a column of lists of structs), field, entity in messages, domain, whether pipes part values, whether blank is allowed.
CHECKS = [
    ("people", "role", "person", "person_role", True, False),
    ("locations", "location_type", "location", "location_type", True, False),
    ("organizations", "org_type", "organization", "org_type", True, False),
    ("events", "event_type", "event", "event_type", True, False),
    ("allegations", "severity", "allegation", "allegation_severity", True, True),
    ("allegations", "status", "allegation", "allegation_status", True, False),
    ("associations", "nature", "association", "association_nature", False, False),
    ("identity_documents", "document_type", "identity_document", "identity_document_type", False, False),
    ("communications", "communication_type", "communication", "communication_type", False, False),
    ("legal_documents", "document_type", "legal_document", "legal_document_type", False, False),
    ("transactions", "transaction_type", "transaction", "transaction_type", False, False),
    ("physical_evidence", "evidence_type", "physical_evidence", "physical_evidence_type", False, False),
    ("redacted_entities", "redaction_type", "redacted_entity", "redaction_type", False, False),
    ("redacted_entities", "confidence", "redacted_entity", "confidence", False, False),
]


def _messages(values: Column, entity: str, field: str, domain: str, split: bool, blank: bool, doc: Column) -> Column:
    """Messages of the values outside the domain; a null value is an absent key and isn't checked."""
    given = F.filter(values, lambda v: v.isNotNull())
    if split:
        given = F.flatten(F.transform(given, lambda v: F.transform(F.split(v, r"\|", -1), T.strip)))
    allowed = (*DOMAINS[domain], "") if blank else DOMAINS[domain]
    wrong = F.filter(given, lambda v: ~v.isin(*allowed))
    return F.transform(wrong, lambda v: F.concat(F.lit(f"Invalid {entity}.{field}: '"), v, F.lit("' in doc "), doc))


def _field(listed: Column, name: str) -> Column:
    return F.transform(listed, lambda e: e[name])


def validate(extractions: DataFrame) -> DataFrame:
    """doc_id, is_valid, violations of each record, by all checks whose category is a column; nothing is shuffled.

    Violations come category by category, severity before status and type before confidence; repeated
    values give repeated messages. A null category has no violations.
    """
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    have = {f.name: f.dataType for f in extractions.schema if isinstance(f.dataType, ArrayType)}
    found = []
    for category, field, *rest in CHECKS:
        if category in have and field in have[category].elementType.fieldNames():
            listed = F.coalesce(F.col(category), F.array().cast(have[category]))
            found.append(_messages(_field(listed, field), rest[0], field, *rest[1:], doc))
    every = F.concat(*found) if found else F.array().cast("array<string>")
    return extractions.select("doc_id", every.alias("violations")).select("doc_id", (F.size("violations") == 0).alias("is_valid"), "violations")


def alerts(checked: DataFrame, provider: Column | str = "provider") -> DataFrame:
    """The alerts to append: one for each record with a violation at least."""
    name = F.lit(provider) if isinstance(provider, str) else provider
    return checked.where(~F.col("is_valid")).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("doc_id").cast("string").alias("doc_id"), name.alias("provider"), "violations")
