"""Reading facts, assets and offers; writing tables and snapshots."""

from loanlens.sources import assets, offers, scans, schemas, sinks

__all__ = ["assets", "offers", "scans", "schemas", "sinks"]
