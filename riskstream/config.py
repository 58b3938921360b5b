"""Settings. Defaults suit a laptop; the environment overrides them; secrets have no default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """Everything a job needs to know about where it runs."""

    kafka_servers: str = "localhost:9092"
    kafka_topic: str = "transactions"
    kafka_acks: str = "all"
    kafka_retries: int = 3
    kafka_compression: str = "snappy"
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int = 1000
    max_files_per_trigger: int = 1000
    archive_trigger: str = "10 seconds"
    alert_trigger: str = "2 seconds"
    lake_root: str = "data"
    retention_days: int = 30
    dead_letters: bool = False  # keep batches that fail and go on, instead of stopping
    drop_resent_within: str | None = None  # drop messages that come again within this time, as "1 hour"
    object_store_endpoint: str | None = None
    object_store_key: str | None = None
    object_store_secret: str | None = field(default=None, repr=False)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        names = {
            "kafka_servers": "KAFKA_BOOTSTRAP_SERVERS",
            "kafka_topic": "KAFKA_TRANSACTION_TOPIC",
            "lake_root": "LAKE_ROOT",
            "archive_trigger": "ARCHIVE_TRIGGER",
            "alert_trigger": "ALERT_TRIGGER",
            "drop_resent_within": "DROP_RESENT_WITHIN",
            "object_store_endpoint": "S3_ENDPOINT",
            "object_store_key": "S3_ACCESS_KEY",
            "object_store_secret": "S3_SECRET_KEY",
        }
        numbers = {
            "max_offsets_per_trigger": "MAX_OFFSETS_PER_TRIGGER",
            "max_files_per_trigger": "MAX_FILES_PER_TRIGGER",
            "retention_days": "ALERT_RETENTION_DAYS",
        }
        found: dict = {k: env[v] for k, v in names.items() if env.get(v)}
        found.update({k: int(env[v]) for k, v in numbers.items() if env.get(v)})
        found["dead_letters"] = env.get("DEAD_LETTERS", "").lower() in ("1", "true", "yes")
        return cls(**found)

    @property
    def archive_path(self) -> str:
        return f"{self.lake_root}/archive/transactions"

    @property
    def alerts_path(self) -> str:
        return f"{self.lake_root}/alerts"

    @property
    def bad_records_path(self) -> str:
        return f"{self.lake_root}/bad_records"

    @property
    def dead_letter_path(self) -> str | None:
        return f"{self.lake_root}/dead_letters" if self.dead_letters else None

    @property
    def progress_path(self) -> str:
        return f"{self.lake_root}/progress"

    def checkpoint(self, query: str) -> str:
        return f"{self.lake_root}/checkpoints/{query}"

    def kafka_source_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.kafka_servers,
            "subscribe": self.kafka_topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": "false",
            "maxOffsetsPerTrigger": str(self.max_offsets_per_trigger),
        }

    def kafka_sink_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.kafka_servers,
            "topic": self.kafka_topic,
            "kafka.acks": self.kafka_acks,
            "kafka.retries": str(self.kafka_retries),
            "kafka.compression.type": self.kafka_compression,
        }

    def spark_options(self) -> dict[str, str]:
        """Session options. Shuffle sizing is left to adaptive execution."""
        options = {
            "spark.sql.session.timeZone": "UTC",
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.coalescePartitions.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
        }
        if self.object_store_endpoint:
            options["spark.hadoop.fs.s3a.endpoint"] = self.object_store_endpoint
            options["spark.hadoop.fs.s3a.path.style.access"] = "true"
        if self.object_store_key and self.object_store_secret:
            options["spark.hadoop.fs.s3a.access.key"] = self.object_store_key
            options["spark.hadoop.fs.s3a.secret.key"] = self.object_store_secret
        return options
