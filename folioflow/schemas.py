"""Table contracts: columns, keys, references, defaults, and value domains."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Document states.
STATUSES = [
    "Uploaded",
    "Queued",
    "Pending",
    "ExtractingText",
    "AnalyzingContent",
    "Processed",
    "TextExtractionFailed",
    "ContentAnalysisFailed",
    "Failed",
    "Cancelled",
    "PartiallyProcessed",
    "EntitiesExtractionFailed",
    "RisksAnalysisFailed",
    "InsightsGenerationFailed",
    "Analyzed",
]
# File types.
FILE_TYPES = [
    "PDF", "DOCX", "DOC", "TXT", "RTF", "PNG", "JPG", "JPEG", "TIFF",
    "XLS", "XLSX", "PPT", "PPTX", "CSV", "JSON", "XML", "HTML", "OTHER",
]
EXTRACTING = "ExtractingText"
PROCESSED = "Processed"
EXTRACTION_FAILED = "TextExtractionFailed"
FAILED = "Failed"

INT, LONG, TEXT, BOOL = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()
TIME = T.TimestampNTZType()
VECTOR = T.ArrayType(T.FloatType())
NOW = "now()"


def varchar(n: int) -> T.VarcharType:
    return T.VarcharType(n)


def need(name: str, dtype: T.DataType, default: str | None = None) -> T.StructField:
    return T.StructField(name, dtype, False, {"default": default} if default is not None else None)


def may(name: str, dtype: T.DataType, default: str | None = None) -> T.StructField:
    return T.StructField(name, dtype, True, {"default": default} if default is not None else None)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    on_delete: str  # cascade | restrict | set_null
    parent_column: str = "id"


@dataclass(frozen=True)
class Contract:
    """What a table promises. Defaults are SQL expressions in the field metadata."""

    name: str
    schema: T.StructType
    primary_key: list[str] = field(default_factory=lambda: ["id"])
    unique: list[list[str]] = field(default_factory=list)
    foreign_keys: list[ForeignKey] = field(default_factory=list)
    identity: bool = True

    @property
    def defaults(self) -> dict[str, str]:
        return {f.name: f.metadata["default"] for f in self.schema if "default" in f.metadata}

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def max_lengths(self) -> dict[str, int]:
        return {
            f.name: f.dataType.length for f in self.schema if isinstance(f.dataType, T.VarcharType)
        }

    @property
    def decimals(self) -> dict[str, T.DecimalType]:
        return {
            f.name: f.dataType for f in self.schema if isinstance(f.dataType, T.DecimalType)
        }


STAMPS = [need("created_at", TIME, NOW), need("updated_at", TIME, NOW)]
OF_USER = ForeignKey("user_id", "asp_net_users", "cascade")
OF_DOCUMENT = ForeignKey("document_id", "documents", "cascade")

MIGRATION = [may("retry_count", INT, "0"), may("processing_notes", TEXT, "''")]

_TABLES = [
    Contract(
        "asp_net_roles",
        T.StructType([
            need("id", TEXT),
            may("name", varchar(256)),
            may("normalized_name", varchar(256)),
            may("concurrency_stamp", TEXT),
        ]),
        unique=[["normalized_name"]],
        identity=False,
    ),
    Contract(
        "asp_net_users",
        T.StructType([
            need("id", TEXT),
            may("user_name", varchar(256)),
            may("normalized_user_name", varchar(256)),
            may("email", varchar(256)),
            may("normalized_email", varchar(256)),
            need("email_confirmed", BOOL),
            may("password_hash", TEXT),
            may("security_stamp", TEXT),
            may("concurrency_stamp", TEXT),
            may("phone_number", TEXT),
            need("phone_number_confirmed", BOOL),
            need("two_factor_enabled", BOOL),
            may("lockout_end", TIME),
            need("lockout_enabled", BOOL),
            need("access_failed_count", INT),
        ]),
        unique=[["normalized_user_name"]],
        identity=False,
    ),
    Contract(
        "a_i_configurations",
        T.StructType([
            need("id", INT),
            may("user_id", TEXT),
            may("max_tokens", TEXT, "'4000'"),
            may("temperature", TEXT, "'0.7'"),
            may("default_provider", TEXT),
            *STAMPS,
        ]),
        unique=[["user_id"]],
        foreign_keys=[OF_USER],
    ),
    Contract(
        "a_i_provider_configs",
        T.StructType([
            need("id", INT),
            need("a_i_configuration_id", INT),
            need("provider", TEXT),
            need("api_key", varchar(200)),
            need("selected_model", varchar(100)),
            need("is_enabled", BOOL, "true"),
            may("last_test_result", BOOL),
            may("last_test_message", varchar(500)),
            may("last_tested_at", TIME),
            *STAMPS,
        ]),
        foreign_keys=[ForeignKey("a_i_configuration_id", "a_i_configurations", "cascade")],
    ),
    Contract(
        "asp_net_role_claims",
        T.StructType([
            need("id", INT),
            need("role_id", TEXT),
            may("claim_type", TEXT),
            may("claim_value", TEXT),
        ]),
        foreign_keys=[ForeignKey("role_id", "asp_net_roles", "cascade")],
    ),
    Contract(
        "asp_net_user_claims",
        T.StructType([
            need("id", INT),
            need("user_id", TEXT),
            may("claim_type", TEXT),
            may("claim_value", TEXT),
        ]),
        foreign_keys=[OF_USER],
    ),
    Contract(
        "asp_net_user_logins",
        T.StructType([
            need("login_provider", TEXT),
            need("provider_key", TEXT),
            may("provider_display_name", TEXT),
            need("user_id", TEXT),
        ]),
        primary_key=["login_provider", "provider_key"],
        foreign_keys=[OF_USER],
        identity=False,
    ),
    Contract(
        "asp_net_user_roles",
        T.StructType([need("user_id", TEXT), need("role_id", TEXT)]),
        primary_key=["user_id", "role_id"],
        foreign_keys=[ForeignKey("role_id", "asp_net_roles", "cascade"), OF_USER],
        identity=False,
    ),
    Contract(
        "asp_net_user_tokens",
        T.StructType([
            need("user_id", TEXT),
            need("login_provider", TEXT),
            need("name", TEXT),
            may("value", TEXT),
        ]),
        primary_key=["user_id", "login_provider", "name"],
        foreign_keys=[OF_USER],
        identity=False,
    ),
    Contract(
        "documents",
        T.StructType([
            need("id", INT),
            need("processed_file_name", varchar(500)),
            may("description", varchar(2000)),
            need("storage_provider", TEXT),
            need("storage_path", varchar(1000)),
            need("file_type", TEXT),
            may("uploaded_by_user_id", TEXT),
            need("uploaded_at", TIME, NOW),
            need("status", TEXT, "'Uploaded'"),
            *STAMPS,
            may("text_extracted", TEXT),
            need("original_file_name", varchar(500), "''"),
            need("file_size", LONG, "0"),
            may("summary", TEXT, "''"),
            may("processing_started_at", TIME),
        ]),
        foreign_keys=[ForeignKey("uploaded_by_user_id", "asp_net_users", "restrict")],
    ),
    Contract(
        "extracted_entities",
        T.StructType([
            need("id", INT),
            need("document_id", INT),
            need("entity_type", TEXT),
            need("value", varchar(500)),
            need("confidence_score", T.DecimalType(5, 4)),
            may("context_excerpt", varchar(1000)),
            may("start_position", INT),
            may("end_position", INT),
            *STAMPS,
        ]),
        foreign_keys=[OF_DOCUMENT],
    ),
    Contract(
        "insights",
        T.StructType([
            need("id", INT),
            need("document_id", INT),
            need("category", TEXT),
            need("description", varchar(1000)),
            need("importance_level", TEXT),
            may("extracted_text", varchar(2000)),
            *STAMPS,
        ]),
        foreign_keys=[OF_DOCUMENT],
    ),
    Contract(
        "risks_detected",
        T.StructType([
            need("id", INT),
            need("document_id", INT),
            need("description", varchar(1000)),
            need("risk_level", TEXT),
            need("confidence_score", T.DecimalType(5, 4)),
            may("evidence_excerpt", varchar(2000)),
            need("detected_at", TIME, NOW),
            *STAMPS,
        ]),
        foreign_keys=[OF_DOCUMENT],
    ),
    Contract(
        "timeline_events",
        T.StructType([
            need("id", INT),
            need("document_id", INT),
            need("event_date", TIME),
            need("event_type", TEXT),
            need("description", varchar(1000)),
            may("source_excerpt", varchar(2000)),
            *STAMPS,
        ]),
        foreign_keys=[OF_DOCUMENT],
    ),
    Contract(
        "chat_sessions",
        T.StructType([
            need("id", INT),
            may("user_id", TEXT),
            need("title", varchar(200)),
            may("description", varchar(500)),
            may("document_id", INT),
            need("message_count", INT, "0"),
            need("last_activity_at", TIME, NOW),
            *STAMPS,
        ]),
        foreign_keys=[OF_USER, ForeignKey("document_id", "documents", "set_null")],
    ),
    Contract(
        "document_chunks",
        T.StructType([
            need("id", INT),
            need("document_id", INT),
            need("chunk_index", INT),
            may("content", TEXT),
            may("embedding", VECTOR),
            need("created_at", TIME),
        ]),
        foreign_keys=[OF_DOCUMENT],
    ),
    Contract(
        "chat_messages",
        T.StructType([
            need("id", INT),
            need("chat_session_id", INT),
            need("role", TEXT),
            need("content", TEXT),
            may("document_id", INT),
            may("document_name", varchar(500)),
            may("token_count", INT),
            may("cost", T.DecimalType(10, 6)),
            may("a_i_provider", TEXT),
            may("model_used", varchar(100)),
            may("response_time_ms", INT),
            *STAMPS,
        ]),
        foreign_keys=[
            ForeignKey("chat_session_id", "chat_sessions", "cascade"),
            ForeignKey("document_id", "documents", "set_null"),
        ],
    ),
]
CONTRACTS = {table.name: table for table in _TABLES}


def migrated(contract: Contract) -> Contract:
    """The contract with the columns the retry migration adds."""
    return replace(contract, schema=T.StructType([*contract.schema.fields, *MIGRATION]))
