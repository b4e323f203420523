"""Training-data operators on Spark tables; each module holds one operator."""
