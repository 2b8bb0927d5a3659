"""Options of a running job. Secrets come from the environment only."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field


# Files in which a micro-batch writes its changed totals, at most.
HISTORY_FILES = 4


@dataclass(frozen=True)
class Kafka:
    bootstrap_servers: str
    topic: str
    starting_offsets: str = "latest"  # of a new checkpoint; an old one goes on where it was
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool = True
    # Further options of the source, such as kafka.security.protocol.
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Landing:
    """A directory of message files instead of a topic."""

    path: str
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = None
    # Further options of the source, such as cleanSource for a directory that grows.
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Cassandra:
    keyspace: str
    table: str
    host: str = "localhost"
    port: int = 9042

    def options(self) -> dict[str, str]:
        return {
            "keyspace": self.keyspace,
            "table": self.table,
            "spark.cassandra.connection.host": self.host,
            "spark.cassandra.connection.port": str(self.port),
        }


@dataclass(frozen=True)
class Jdbc:
    url: str
    table: str
    driver: str
    user_variable: str = "MYSQL_USERNAME"
    password_variable: str = "MYSQL_PASSWORD"
    max_connections: int = 8
    # Further options of reader and writer, such as batchsize.
    options: Mapping[str, str] = field(default_factory=dict)

    def properties(self) -> dict[str, str]:
        secrets = {
            "user": os.environ.get(self.user_variable),
            "password": os.environ.get(self.password_variable),
        }
        known = {name: value for name, value in secrets.items() if value is not None}
        return {"driver": self.driver, **known, **self.options}


@dataclass(frozen=True)
class Settings:
    # Durable folder shared by all machines: one checkpoint per query goes below it.
    checkpoint_root: str
    # Accepted messages go to Cassandra if given, else here; rejects always here.
    archive_path: str
    # Totals go to the database if given, else to this path.
    history_path: str | None = None
    jdbc: Jdbc | None = None
    cassandra: Cassandra | None = None
    # What `run` reads; queries started one by one are given their inputs.
    source: Kafka | Landing | None = None
    customers_path: str | None = None
    keep_raw: bool = False
    # Accepted orders' last versions as a table as well, kept by the archive's query.
    current_path: str | None = None
    current_buckets: int = 256
    trigger: str | None = "15 seconds"  # None: take what is there, then end
    console: bool = False
    # Count a redelivered order once; with a time span, forget ids that long after
    # they arrived.
    dedup: bool = False
    dedup_within: str | None = None
    # Largest measured customer table that is sent to every executor.
    broadcast_bytes: int = 64 * 2**20
    # Width of the join to customers that are not broadcast.
    join_partitions: int | None = None
    # The totals' checkpoint if it lies elsewhere, as after `carry_over`.
    totals_checkpoint: str | None = None
    # Number of state partitions; fixed by the first start of a checkpoint, see `carry_over`.
    state_partitions: int | None = None
    history_files: int = HISTORY_FILES
    # Add up decimals, whose sum does not depend on their order.
    exact: bool = False
    # Count what each batch leaves out, for the progress log; see streaming.dropped.
    counted: bool = False
    # An order that comes again replaces what it added before; the log of such changes goes
    # here, and the history has the number of orders left in each group.
    corrections_path: str | None = None
    # Where a backfill has left its totals and how far it read; the stream goes on there.
    handover_path: str | None = None
    # Extra session settings while a query starts, e.g. a state store provider.
    conf: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.jdbc is None and self.history_path is None:
            raise ValueError("give history_path or jdbc: the totals need a target")
        if self.corrections_path is not None:
            if self.history_path is None:
                raise ValueError("corrections need history_path")
            if self.dedup or self.handover_path is not None:
                raise ValueError("corrections go with neither dedup nor handover_path")
        if self.handover_path is not None and self.dedup:
            raise ValueError("a handover knows no ids: it does not go with dedup")


def from_mapping(config: Mapping[str, Mapping], **others) -> Settings:
    """Settings from a parsed config file.

    Sections: `kafka` or `landing` for the source, `mysql` and `cassandra` for the
    targets, `job` for the fields of Settings. Other sections are left alone.
    """
    values = dict(config.get("job", {}))
    if "kafka" in config:
        kafka = dict(config["kafka"])
        values["source"] = Kafka(kafka.pop("bootstrap_server"), **kafka)
    elif "landing" in config:
        values["source"] = Landing(**config["landing"])
    if "mysql" in config:
        mysql = dict(config["mysql"])
        host, port, database = (mysql.pop(name) for name in ("host", "port", "database"))
        # The rest are fields of Jdbc; a name that is none raises an error.
        values["jdbc"] = Jdbc(f"jdbc:mysql://{host}:{port}/{database}", **mysql)
    if "cassandra" in config:
        values["cassandra"] = Cassandra(**config["cassandra"])
    return Settings(**{**values, **others})


def read_settings(path: str) -> Settings:
    """Settings from a JSON file, or a YAML file where PyYAML is installed."""
    with open(path, encoding="utf-8") as file:
        if not path.endswith((".yaml", ".yml")):
            return from_mapping(json.load(file))
        try:
            import yaml
        except ImportError as error:
            raise ImportError("a YAML config needs PyYAML; use JSON instead") from error
        return from_mapping(yaml.safe_load(file))
