from parcelight.sources.commits import Commits, Conflict, Part
from parcelight.sources.tables import LeadTables, stage_input
from parcelight.sources.tsv import read_source_tables, read_tsv, source_version

__all__ = ["Commits", "Conflict", "LeadTables", "Part", "read_source_tables", "read_tsv", "source_version", "stage_input"]
