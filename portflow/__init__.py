"""portflow: port-logistics reporting on Spark."""
