from talkgrain.plans.analyses import derived_measures, frequency, population_properties
from talkgrain.plans.checks import check_release, corpus_conflicts
from talkgrain.plans.collection import Collection, CollectionLayout, ingest_collection
from talkgrain.plans.session import configured
from talkgrain.plans.sql import register_sql

__all__ = [
    "Collection",
    "CollectionLayout",
    "check_release",
    "configured",
    "corpus_conflicts",
    "derived_measures",
    "frequency",
    "ingest_collection",
    "population_properties",
    "register_sql",
]
