"""Stateful jobs over growing inputs."""
