"""Producer settings as writer options."""

from __future__ import annotations

# Codecs and acknowledgement policies by name. Anything else means
# no compression, and acknowledgement by all replicas.
CODECS = ("gzip", "snappy", "lz4", "zstd", "none")
ACKS = {"tcp": "0", "leader": "1", "cluster": "all"}


def compression_codec(name: str | None) -> str:
    return name if name in CODECS else "none"


def ack_policy(name: str | None) -> str:
    return ACKS.get(name, "all")


def write_options(
    compression: str | None = None,
    acks: str | None = None,
    idempotent: bool = True,
    max_bytes: int | None = None,
    table: bool = False,
) -> dict[str, str]:
    """Writer options for Kafka, or for a Parquet ``table``."""
    codec = compression_codec(compression)
    if table:
        # Parquet calls the framed format of this codec lz4_raw.
        return {"compression": "lz4_raw" if codec == "lz4" else codec}
    policy = ack_policy(acks)
    if idempotent and policy != "all":
        raise ValueError("idempotent writes need acknowledgement by the whole cluster")
    options = {
        "kafka.compression.type": codec,
        "kafka.acks": policy,
        "kafka.enable.idempotence": str(idempotent).lower(),
    }
    if max_bytes is not None:
        options["kafka.max.request.size"] = str(max_bytes)
    return options
