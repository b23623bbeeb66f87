"""palimpsest: document-change analytics as Spark DataFrame jobs.

Two snapshots of a corpus go in; out come the documents and paragraphs that
were added, deleted, moved or edited, how large each edit is, who depends on
it, and daily feeds and metrics. Every operator is a ``DataFrame -> DataFrame``
function over Spark SQL built-ins; Arrow (pandas) UDFs are used only for the
word-level redline and sequence alignment.

Sub-packages:
  sources    – scans: snapshots, CSV lists, XML documents, crawl reports, pages
  functions  – Column expressions: distance, trimming, regex extraction, flags
  operators  – relational operators: snapshot diff, paragraph pairing, scoring,
               relevance lookups, term search, feed classification, reports
  plans      – end-to-end jobs composed from the operators
  streaming  – Structured Streaming forms of the daily jobs
  sinks      – CSV / metrics-log writers
"""

from palimpsest.session import get_session, ensure_checkpoint_dir  # noqa: F401
