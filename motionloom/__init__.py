"""Spark analytics for robot-demonstration trajectories."""
