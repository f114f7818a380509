"""Commands for spark-submit: the station load, the trip stream and the mart refresh."""
