"""fleetmart: dimensional warehousing for a vehicle rental business, as Spark DataFrame operators."""
