"""kontor -- ledger ETL and reporting on Spark.

Where things are (see README for the full map):

* ``kontor.plans.turnover``   daily / monthly / any-range account turnover
* ``kontor.plans.f101``       form-101 balance report (one month, or every month in one job)
* ``kontor.plans.posting_stats`` posting min/max and the SQL table function
* ``kontor.plans.detail_load``   extracts -> keyed detail layer (partition-scoped upserts)
* ``kontor.plans.marts``      mart export / re-import
* ``kontor.plans.runlog``     audit rows and the chunked, numbered message log
* ``kontor.operators``        upsert / merge, delta fold, valid-at joins, sequence ids, sized broadcasts
* ``kontor.sources`` / ``kontor.sinks``  CSV, Parquet, numbered delta folders, slices, versions, buckets
* ``kontor.streaming.mirror`` the delta mirror as a Structured Streaming job
* ``kontor.jobs``             the end-to-end jobs and CLI (``python -m kontor.jobs ...``)
"""
