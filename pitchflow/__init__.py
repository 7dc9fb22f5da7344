"""pitchflow: pitch-event analytics as Spark DataFrame operators."""
