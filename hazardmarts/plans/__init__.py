"""The models, gates, table tests, views and the daily job, composed of the operators."""
