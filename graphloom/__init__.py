"""graphloom: corpus -> chunks -> knowledge graph -> hybrid retrieval, as Spark DataFrame plans."""
