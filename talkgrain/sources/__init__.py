from talkgrain.sources.buckets import bucketed_table, write_bucketed
from talkgrain.sources.copies import differing_ranges, mirror_ranges, multiset_digest
from talkgrain.sources.jdbc import JdbcSplit, jdbc_tables, read_release_jdbc
from talkgrain.sources.manifest import load_manifest, resolve_release, write_manifest
from talkgrain.sources.releases import (
    mirror_release,
    mirror_store,
    read_release,
    read_releases,
    release_table,
    write_release,
)
from talkgrain.sources.scans import broadcast_if_small, spread
from talkgrain.sources.xml import TranscriptLayout, ingest_transcripts

__all__ = [
    "JdbcSplit",
    "TranscriptLayout",
    "broadcast_if_small",
    "bucketed_table",
    "differing_ranges",
    "ingest_transcripts",
    "jdbc_tables",
    "load_manifest",
    "mirror_ranges",
    "mirror_release",
    "mirror_store",
    "multiset_digest",
    "read_release",
    "read_release_jdbc",
    "read_releases",
    "release_table",
    "resolve_release",
    "spread",
    "write_bucketed",
    "write_manifest",
    "write_release",
]
