"""spendstar: a Spark-native warehouse for marketing-campaign events.

Layers: raw CSV -> bronze (verbatim text) -> silver (typed, cleaned, FX-normalised,
de-duplicated) -> gold star schema (dim_date, dim_channel, dim_campaign,
fact_campaign_performance) -> quality gate -> marts and a JSON extract.

Every transform is a ``DataFrame -> DataFrame`` function built from Spark's
built-in expressions; actions happen only where a decision needs a number
(key assignment, the gate) or where a layer is written.
"""

__version__ = "0.1.0"
