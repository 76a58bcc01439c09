"""The stages: ingest, clean, features, model, scoring, export, audit."""
